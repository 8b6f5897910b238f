"""Text of scanned pages made readable: lines labelled by a linear conditional model, words mended by a corpus lexicon.

Every line of a text of several lines is described by layout features: its form (page number, number and version of a
standard, a known title, capitals, length and ending), its place in the text, how much of it is capitals, digits and words
of titles, gaps inside it, and whether it stands in the middle of a sentence. A linear-chain model over the labels header,
body and break weighs them together with the label before. It is trained here, on a bounded sample of labelled rows:
running headers and page numbers, from rows that are typed as such, are put between the lines of other rows' texts, and an
averaged perceptron learns to tell them again. Lines of those texts that look like headers themselves stay out of training.
All texts are then labelled, many at a time, by the best path through the model. Header lines go, body lines are joined,
and a break ends a paragraph.

Words are counted over all texts. A word is misread if undoing at most MOST_MENDS usual confusions of characters gives one
that is RATIO times as common: words that confusions can lead to one another have one key, by which every word is joined
with the common ones, and the confusions of each pair that meets are counted exactly. A line-end hyphen is taken out if the halves join to a known or so mended word, and kept in compounds.
Every distinct word and every word that halves may make is joined with the counts of all words, so that no word is too
rare to count. Tasks get the mends and the halves that join, the model's weights, and the fixed reference list's titles.

Defined results: null texts come out null and undamaged; a row without page takes it from its id, or has no page
number to find; a null type isn't scanned; unknown standards still show by their form; repeated rows are treated alike;
empty tables give empty results; further columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.plans.session import materialize

RATIO, MOST_MENDS = 20, 4
#: Labelled header rows and texts that the model is trained on, by the order of a hash, how much of a text, and how often.
TRAIN_HEADERS, TRAIN_TEXTS, TRAIN_CHARS, ROUNDS = 3_000, 6_000, 4_000, 6
#: What is read for what.
CONFUSIONS = (("c", "e"), ("cl", "d"), ("ii", "u"), ("b", "h"), ("f", "t"), ("q", "g"), ("rn", "m"), ("vv", "w"), ("5", "s"), ("1", "l"), ("1", "i"), ("!", "i"), ("|", "l"), ("0", "o"), ("ﬂ", "fl"), ("ﬁ", "fi"), ("ſ", "s"), ("li", "h"), ("8", "b"), ("6", "b"), ("9", "g"), ("$", "s"))
HYPHENS = "-­‐‑¬"

_WORD = re.compile(r"[^\W_]+(?:[!|$][^\W_]+)*")
_BROKEN = re.compile(rf"([^\W_]+(?:[!|$][^\W_]+)*)[{HYPHENS}][^\S\n]*$")
_NEXT = re.compile(r"\s*([^\W_]+(?:[!|$][^\W_]+)*)")
_STANDARD = re.compile(r"^\s*(?:\d{1,4}\s+)?(?:(?:final\s+)?draft\s+)?(?:[a-z]{3,5}\s+)?(?:en|ts|tr|es|eg)[ _]?\d{3}[ _]?\d{3}(?:[-–]\d{1,2})?\s+v\d+\.\d+\.\d+(?:\s+\(\d{4}-\d{2}\))?(?:\s+wp(?:\s+\w+){1,3})?(?:\s+\d{1,4})?\s*$", re.I)
_PAGE = re.compile(r"^\s*(?:(?P<deco>(?:p\.|page|seite|[-–—\[(])\s*)(?P<a>\d{1,4})\s*(?:[-–—\])]|(?:of|von|/)\s*\d{1,4})?|(?P<b>\d{1,6})(?P<of>\s*/\s*\d{1,4})?)\s*$", re.I)
_ID_PAGE = re.compile(r"_p(\d{1,5})_")

BLANK, PAGE, OTHER_PAGE, NUMBER, STANDARD, TITLE, CAPITALS, SHORT_END, LONG_END, SHORT, LONG = range(11)
START = 11
HEADER, BODY, BREAK = range(3)


def squeezed(text: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", text.lower()))


class Layout:
    """Layout classes of lines; titles are those of the reference list, squeezed."""

    def __init__(self, titles: frozenset[str]):
        self.titles = titles

    def _is_title(self, line: str) -> bool:
        s = squeezed(line)
        if s in self.titles:
            return True
        words = s.split(" ")
        for cut in range(1, 5):  # a work group's name beside the title
            if len(words) > cut and (words[0] == "wp" and " ".join(words[cut:]) in self.titles or words[-cut] == "wp" and " ".join(words[:-cut]) in self.titles):
                return True
        return False

    def classes(self, lines: list[str], page: int | None) -> list[int]:
        longest = max(map(len, lines))
        out = []
        for line in lines:
            s = line.strip()
            if not s:
                out.append(BLANK)
            elif len(s) < 24 and (m := _PAGE.match(s)):
                n = int(m["a"] or m["b"])
                if page is not None and n in (page, page + 1):
                    out.append(PAGE)
                else:
                    out.append(OTHER_PAGE if m["deco"] or m["of"] else NUMBER)
            elif len(s) < 160 and _STANDARD.match(s):
                out.append(STANDARD)
            elif len(s) < 240 and s[-1] not in ".:;" and self._is_title(s):
                out.append(TITLE)
            elif s.isupper():
                out.append(CAPITALS)
            else:
                out.append((SHORT_END if s[-1] in ".!?:" else SHORT) + (len(line) > 0.75 * longest))
        return out


_MARGIN = (PAGE, OTHER_PAGE, STANDARD, TITLE)
_VERSION = re.compile(r"\bv\d+\.\d+|\b\d{3} \d{3}\b", re.I)
_GAP = re.compile(r"\S(?: {3,}|\t+| [—–|] )\S")
#: How many values each feature has; a line has one value of each.
FEATURES = (11, 22, 4, 12, 8, 6, 4, 2)
_FROM = np.cumsum((0, *FEATURES[:-1]))


def _bucket(x: float, *ends: float) -> int:
    return sum(x >= e for e in ends)


def described(lines: list[str], forms: list[int], words: frozenset[str]) -> list[list[int]]:
    """The features of each line, given its form and the words of known titles."""
    stripped = [x.strip() for x in lines]
    ends = [not x or x[-1] in ".!?:;" for x in stripped]
    low = [x[:1].islower() for x in stripped]
    real = [e not in (BLANK, *_MARGIN) for e in forms]
    last, before = -1, []
    for i, r in enumerate(real):  # the last line of running text before each
        before.append(last)
        last = i if r else last
    nxt, after = -1, [0] * len(lines)
    for i in range(len(lines) - 1, -1, -1):
        after[i] = nxt
        nxt = i if real[i] else nxt
    longest = max(1, max(map(len, lines)))
    out = []
    for i, (x, e) in enumerate(zip(stripped, forms)):
        goes_on = after[i] >= 0 and low[after[i]]
        inside = int(before[i] >= 0 and not ends[before[i]] and goes_on)
        n = max(1, len(x))
        letters = sum(map(str.isalpha, x))
        capitals = sum(map(str.isupper, x)) / max(1, letters)
        digits = sum(map(str.isdigit, x)) / n
        own = squeezed(x).split(" ")
        known = sum(w in words for w in own) / len(own)
        place = 0 if len(lines) == 1 else 1 if i == 0 else 3 if i == len(lines) - 1 else 2
        out.append([
            e, e * 2 + inside, place, _bucket(capitals, 0.2, 0.6, 0.95) * 3 + _bucket(n / longest, 0.4, 0.8), _bucket(known, 0.3, 0.6, 0.8) * 2 + inside,
            _bucket(digits, 0.05, 0.5) * 2 + bool(_VERSION.search(x)), 2 * (before[i] >= 0 and not ends[before[i]]) + goes_on, int(bool(_GAP.search(x))),
        ])
    return out


class Lines:
    """The linear-chain model: weights of features by label, of neighbouring labels, and of the first label."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, begin: np.ndarray):
        self.weights, self.move, self.begin = weights, move, begin

    @classmethod
    def fit(cls, sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> Lines:
        """An averaged perceptron over (features, labels) of texts: each round labels all texts in groups and moves the
        weights from what was said to what is true."""
        m = cls(np.zeros((sum(FEATURES), 3)), np.zeros((3, 3)), np.zeros(3))
        for e in range(FEATURES[0]):  # what forms mean where there is nothing to learn from
            m.weights[e, HEADER if e in _MARGIN else BREAK if e in (BLANK, SHORT_END) else BODY] = 1.0
        start = m.weights.copy()
        total, steps = [np.zeros_like(x) for x in (m.weights, m.move, m.begin)], 0
        rng = np.random.default_rng(0)
        for _ in range(rounds):
            for group in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // 20)):
                if not group.size:
                    continue
                feats, sizes = np.concatenate([sequences[i][0] for i in group]), np.array([len(sequences[i][1]) for i in group])
                truth = np.concatenate([sequences[i][1] for i in group])
                said = m.label(feats, sizes)
                first = np.cumsum(sizes) - sizes
                inner = np.ones(truth.size, bool)
                inner[first] = False
                for labels, by in ((truth, 1.0), (said, -1.0)):
                    np.add.at(m.weights, ((feats + _FROM).ravel(), np.repeat(labels, len(FEATURES))), by / 20)
                    np.add.at(m.move, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), by / 20)
                    np.add.at(m.begin, labels[first], by / 20)
                steps += 1
                for t, x in zip(total, (m.weights, m.move, m.begin)):
                    t += x
        return cls(*(t / steps for t in total)) if steps else cls(start, m.move, m.begin)

    def label(self, feats: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The labels of the best path through each text; feats has a row a line, sizes the lines of each text, one at least.

        All texts take a step at a time, longer ones first, so that those that are done are the tail."""
        o = np.argsort(-sizes, kind="stable")
        first, longest = (np.cumsum(sizes) - sizes)[o], int(sizes.max(initial=0))
        score = self.weights[feats + _FROM].sum(1)
        out = np.zeros(len(feats), np.int64)
        if not sizes.size:
            return out
        back = np.zeros((len(feats), 3), np.int8)
        best = self.begin + score[first]
        alive = np.searchsorted(-sizes[o], -np.arange(1, longest + 1), "right")  # texts of at least so many lines
        final = np.zeros(sizes.size, np.int64)
        for t in range(1, longest + 1):
            n = alive[t] if t < longest else 0
            final[n : alive[t - 1]] = best[n : alive[t - 1]].argmax(1)
            if n:
                way = best[:n, :, None] + self.move
                at = first[:n] + t
                back[at] = way.argmax(1)
                best = way.max(1) + score[at]
        for t in range(longest - 1, -1, -1):
            n = alive[t]
            at = first[:n] + t
            out[at] = final[:n]
            if t:
                final[:n] = back[at, final[:n]]
        return out


#: Ways in which a page's number is printed on a line of its own.
NUMBERED = ("{}", "   {}", "- {} -", "– {} –", "[{}]", "({})", "p. {}", "page {} of {}", "{} / {}")


def names_standard(line: str, form: int, words: frozenset[str]) -> bool:
    """Whether a line can be a running header: a number and version, or mostly words of titles, in capitals."""
    if form in (STANDARD, TITLE) or (len(line) < 120 and _VERSION.search(line) and line.strip()[-1:] not in ".:;"):
        return True
    own = squeezed(line).split(" ")
    return len(own) > 3 and sum(w in words for w in own) >= 0.5 * len(own) and sum(map(str.isupper, line)) >= 0.5 * sum(map(str.isalpha, line))


def _misread(line: str, rng: np.random.Generator, share: float = 0.04) -> str:
    """line with some of its characters read as what they're often read for."""
    out = line
    for wrong, right in CONFUSIONS:
        out = re.sub(re.escape(right), lambda m, w=wrong: w if rng.random() < share else m[0], out, flags=re.I)
    return out


def training_sequences(headers: list[tuple[str, int | None]], texts: list[tuple[str, int | None]], layout: Layout, words: frozenset[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of texts (text, page) with running headers and page numbers put between their lines.

    Running headers are lines of the header rows (text, page) that name a standard, some with misread characters; other
    notices among those rows are repeated lines, not headers. Page numbers are printed as in NUMBERED.
    """
    rng = np.random.default_rng(1)
    margin = [x.strip() for t, p in headers for x, e in zip(t.split("\n"), layout.classes(t.split("\n"), p)) if x.strip() and names_standard(x, e, words)]
    out = []
    for text, page in texts:
        lines = text.split("\n")
        forms = layout.classes(lines, page)
        kept = [x for x, e in zip(lines, forms) if e not in _MARGIN and not names_standard(x, e, words)]
        if not kept:
            continue
        longest = max(map(len, kept))
        labels = [BREAK if not x.strip() or x.rstrip()[-1] in ".!?:" and len(x) <= 0.75 * longest else BODY for x in kept]
        for _ in range(int(rng.integers(0, 3))):
            if page is not None and rng.random() < 0.5:
                x = NUMBERED[int(rng.integers(len(NUMBERED)))].format(page + int(rng.integers(2)), page + 20)
            elif margin:
                x = _misread(margin[int(rng.integers(len(margin)))], rng)
            else:
                continue
            at = int(rng.integers(len(kept) + 1))
            kept.insert(at, x)
            labels.insert(at, HEADER)
        if len(kept) > 1:
            out.append((np.array(described(kept, layout.classes(kept, page), words)), np.array(labels)))
    return out


#: What confusions make one: single characters first, then characters that stand for two. Every confusion keeps the key.
_ONE, _OTHER = "etq9l1!|5$ſ0bh86", "cfggiiiisssouuuu"
_TWO = (("ﬂ", "fi"), ("ﬁ", "fi"), ("d", "ci"), ("u", "ii"), ("m", "rn"), ("w", "vv"))


def confusion_key(word: Column) -> Column:
    """The same for all words that confusions lead to one another."""
    out = F.translate(word, _ONE, _OTHER)
    for c, two in _TWO:
        out = F.replace(out, F.lit(c), F.lit(two))
    return out


def _seen_as() -> dict[str, list[tuple[str, int]]]:
    """What is seen -> (what it may be, confusions): every confusion, and confusions of what a confusion left."""
    found: dict[tuple[str, str], int] = {}
    for right in {r for _, r in CONFUSIONS}:
        layer = {right}
        for n in range(1, MOST_MENDS + 1):
            layer = {w[:at] + wrong + w[at + len(r) :] for w in layer for wrong, r in CONFUSIONS for at in range(len(w)) if w.startswith(r, at)}
            for w in layer:
                found.setdefault((w, right), n)
    out: dict[str, list[tuple[str, int]]] = {}
    for (w, right), n in found.items():
        out.setdefault(w, []).append((right, n))
    return out


_SEEN_AS = _seen_as()
_LONGEST = max(map(len, _SEEN_AS))


def confusions(word: str, meant: str, most: int = MOST_MENDS) -> int | None:
    """The fewest confusions by which meant is read as word; None if they're more than most."""
    at: dict[tuple[int, int], int] = {(0, 0): 0}
    for i in range(len(word)):
        for j in [b for a, b in at if a == i]:
            cost = at[i, j]
            steps = [(1, 1, 0)] if j < len(meant) and word[i] == meant[j] else []
            for n in range(1, min(_LONGEST, len(word) - i) + 1):
                steps += [(n, len(right), k) for right, k in _SEEN_AS.get(word[i : i + n], ()) if meant.startswith(right, j)]
            for n, m, k in steps:
                if cost + k <= min(most, at.get((i + n, j + m), most)):
                    at[i + n, j + m] = cost + k
    return at.get((len(word), len(meant)))


def halves(lines: list[str], classes: list[int]) -> set[str]:
    """All words that broken ones may make of their halves, whichever header lines between them go."""
    out: set[str] = set()
    before: list[set[str]] = [set() for _ in lines]  # what may be joined to the beginning of each line
    for i, line in enumerate(lines):
        if not (m := _BROKEN.search(line)):
            continue
        left = {m[1]}
        if not line[: m.start(1)].strip():
            left |= {b + m[1] for b in before[i]}
        for j in range(i + 1, len(lines)):
            if n := _NEXT.match(lines[j]):
                out |= {(b + n[1]).lower() for b in left}
                before[j] |= left
            if classes[j] not in (*_MARGIN, CAPITALS):
                break
    return out


def _page_of(page: float | None, key: str | None) -> int | None:
    if page is not None and page == page:
        return int(page)
    m = _ID_PAGE.search(key or "")
    return int(m[1]) if m else None


class Scan:
    """All that a task needs to read scanned text."""

    def __init__(self, titles: frozenset[str], model: Lines, mends: dict[str, str], joined: frozenset[str]):
        self.layout, self.model, self.mends, self.joined = Layout(titles), model, mends, joined
        self.words = title_words(titles)

    def read_all(self, texts: list[str], pages: list[int | None], whole: bool = True) -> list[tuple[set[str], str | None]]:
        """(kinds of damage, mended text if whole) of each text."""
        lines = [t.split("\n") for t in texts]
        many = [i for i, x in enumerate(lines) if len(x) > 1]
        forms = {i: self.layout.classes(lines[i], pages[i]) for i in many}
        states: dict[int, list[int]] = {}
        if many:
            feats = np.array([f for i in many for f in described(lines[i], forms[i], self.words)])
            sizes = np.array([len(lines[i]) for i in many])
            labels = self.model.label(feats, sizes).tolist()
            end = 0
            for i, n in zip(many, sizes.tolist()):
                states[i] = labels[end : end + n]
                end += n
        return [self._mended(x, forms.get(i, [LONG_END]), states.get(i, [BODY]), whole) for i, x in enumerate(lines)]

    def _mended(self, lines: list[str], forms: list[int], states: list[int], whole: bool) -> tuple[set[str], str | None]:
        damage, kept = set(), []
        for line, e, s in zip(lines, forms, states):
            if s == HEADER and e != BLANK:
                running = names_standard(line, e, self.words)
                if e == PAGE:
                    damage.add("page_nr")
                elif running:
                    damage.add("header")
                if running or e in (PAGE, OTHER_PAGE):
                    continue
            kept.append([line, s])
        i = 0
        while i + 1 < len(kept):
            line = kept[i][0]
            m, n = _BROKEN.search(line), _NEXT.match(kept[i + 1][0])
            if m and n and (m[1] + n[1]).lower() in self.joined:
                damage.add("hyphen")
                kept[i : i + 2] = [[line[: m.end(1)] + kept[i + 1][0].lstrip(), kept[i + 1][1]]]
            elif m and n and n[1][0].islower():  # a compound, broken at its own hyphen
                kept[i : i + 2] = [[line.rstrip() + kept[i + 1][0].lstrip(), kept[i + 1][1]]]
            else:
                i += 1
        mends = self.mends
        for k in kept:
            wrong = {w for w in set(_WORD.findall(k[0])) if w.lower() in mends}
            if wrong:
                damage.add("char")
                if whole:
                    k[0] = _WORD.sub(lambda m, wrong=wrong: _cased(mends[m[0].lower()], m[0]) if m[0] in wrong else m[0], k[0])
        return damage, _paragraphs(kept) if whole else None


def title_words(titles: frozenset[str]) -> frozenset[str]:
    return frozenset(w for t in titles for w in t.split(" "))


def _cased(word: str, like: str) -> str:
    return word.upper() if like.isupper() else word[:1].upper() + word[1:] if like[:1].isupper() else word


def _paragraphs(kept: list[list]) -> str:
    """Body lines joined by spaces; a break ends a paragraph, unless the text plainly goes on in lower case."""
    out: list[str] = []
    run: list[str] = []
    for (line, state), (after, _) in zip(kept, [*kept[1:], ["", BODY]]):
        if line.strip():
            run.append(line.strip())
        if (state == BREAK and not after.lstrip()[:1].islower() or not line.strip()) and run:
            out.append(" ".join(run))
            run = []
    if run:
        out.append(" ".join(run))
    return "\n".join(out)


def _statistics(rows: DataFrame, titles: frozenset[str]) -> tuple[Lines, dict[str, str], frozenset[str]]:
    """The trained model, the misread words with those meant, and the words that halves may be joined to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layout, words, other = Layout(titles), Counter(), Counter()

        def flush() -> pd.DataFrame:
            got = [("w", k, v) for k, v in words.items()] + [(kind, k, v) for (kind, k), v in other.items()]
            words.clear()
            other.clear()
            return pd.DataFrame(got, columns=["kind", "key", "n"])

        for b in batches:
            for kind, text, page, key in zip(b["type"], b["text"], b["page"], b["id"]):
                lines = text.split("\n")
                if kind in ("HEADER", "FOOTER"):
                    continue
                low = text.lower()
                words.update(_WORD.findall(low))
                if len(low) != len(text):  # a letter became several, which may cut words
                    other.update(("j", w.lower()) for w in _WORD.findall(text))
                if len(lines) > 1:
                    c = layout.classes(lines, _page_of(page, key))
                    other.update(("j", w) for w in halves(lines, c))
            if len(words) + len(other) > 500_000:
                yield flush()
        yield flush()

    counts = materialize(rows.mapInPandas(run, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "scan-counts")
    is_word = F.col("kind") == "w"
    asked = counts.where("kind IN ('w', 'j')").groupBy(F.col("key").alias("word")).agg(F.coalesce(F.max(F.when(is_word, F.col("n"))), F.lit(0)).alias("n"), F.max(~is_word).alias("half"))
    letters = F.length(F.regexp_replace("word", r"[^\p{L}]", ""))
    odd = asked.where(letters >= 2).select("word", (F.greatest("n", F.lit(1)) * RATIO).alias("own"), confusion_key(F.col("word")).alias("same"))
    known = counts.where(f"kind = 'w' AND n >= {RATIO}").select(F.col("key").alias("meant"), F.col("n").alias("k"), confusion_key(F.col("key")).alias("same"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            layers = [confusions(w, m) for w, m in zip(b["word"], b["meant"])]
            yield b.assign(layer=layers).dropna(subset=["layer"]).astype({"layer": int})

    may = odd.join(known, "same").where("k >= own AND word <> meant").select("word", "meant", "k")
    may = may.mapInPandas(count, "word string, meant string, k long, layer int")
    # fewest confusions first, then the commonest word
    best = may.groupBy("word").agg(F.min(F.struct("layer", (-F.col("k")).alias("k"), "meant")).alias("best"))
    best = materialize(best.select("word", "best.meant"), "scan-mends")
    mends = {r["word"]: r["meant"] for r in best.collect()}
    halved = asked.where("half").join(best, "word", "left").where("n >= 3 OR meant IS NOT NULL").select("word")
    joined = {r["word"] for r in halved.collect()}
    return trained(rows, titles), mends, frozenset(joined)


def sample(rows: DataFrame, headers: int = TRAIN_HEADERS, texts: int = TRAIN_TEXTS) -> tuple[list[tuple], list[tuple]]:
    """(text, page) of header rows, and of other rows with several lines: the first of each by a hash of row and text."""
    margin, many = F.col("type").isin("HEADER", "FOOTER"), ~F.col("type").isin("HEADER", "FOOTER") & F.col("text").contains("\n")
    order = F.xxhash64("row_nr", "text")
    n = rows.agg(F.count_if(margin).alias("headers"), F.count_if(many).alias("texts")).first()

    def some(kind: Column, want: int, have: int) -> list[tuple]:
        # a share of the hashes holds about twice as many as are wanted, so that no task sends more than its part of them
        near = F.pmod(order, F.lit(1 << 30)) <= int(min(1.0, 2 * want / max(1, have)) * (1 << 30))
        got = rows.where(kind & near).orderBy(F.pmod(order, F.lit(1 << 30)), "text").limit(want).select(F.left("text", F.lit(TRAIN_CHARS)).alias("text"), "page", "id")
        return [(r["text"], _page_of(r["page"], r["id"])) for r in got.collect()]

    return some(margin, headers, n["headers"]), some(many, texts, n["texts"])


def trained(rows: DataFrame, titles: frozenset[str]) -> Lines:
    return Lines.fit(training_sequences(*sample(rows), Layout(titles), title_words(titles)))


def known_titles(titles: list[str]) -> frozenset[str]:
    """Titles without their field, squeezed, and without their part, as running headers give them."""
    plain = [re.sub(r"^[^;]*\([A-Z]+\);\s*", "", t) for t in titles]
    return frozenset(squeezed(x) for t in plain for x in (t, re.sub(r";\s*Part \d+:.*$", "", t))) - {""}


def _prepared(segments: DataFrame, catalog: DataFrame):
    """(rows of scanned text, broadcast ingredients). The reference list is small and fixed; its titles are collected."""
    # keys travel as strings: pandas would turn whole numbers beside nulls into floats
    titles = known_titles([r["title"] for r in catalog.select("title").where("title IS NOT NULL").distinct().collect()])
    rows = segments.where(F.col("type").isin("NORM", "INFORM", "HEADER", "FOOTER") & (F.length("text") > 0)).select(F.col("row_nr").cast("string").alias("row_nr"), "id", "type", "page", "text")
    model, mends, joined = _statistics(rows, titles)
    return rows.where(F.col("type").isin("NORM", "INFORM")), segments.sparkSession.sparkContext.broadcast((titles, model, mends, joined))


def scan_damage(segments: DataFrame, catalog: DataFrame) -> DataFrame:
    """(row_nr, damage): one row a kind of damage found."""
    rows, shared = _prepared(segments, catalog)
    key = F.col("row_nr").cast(dict(segments.dtypes)["row_nr"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = Scan(*shared.value)
        for b in batches:
            read = scan.read_all(b["text"].tolist(), [_page_of(p, i) for p, i in zip(b["page"], b["id"])], False)
            got = [(k, d) for k, r in zip(b["row_nr"], read) for d in sorted(r[0])]
            yield pd.DataFrame(got, columns=["row_nr", "damage"])

    return rows.mapInPandas(run, "row_nr string, damage string").withColumn("row_nr", key)


def mended_text(segments: DataFrame, catalog: DataFrame) -> DataFrame:
    """(row_nr, text, damage): continuous, readable text of every scanned row; damage lists what was mended, sorted."""
    rows, shared = _prepared(segments, catalog)
    key = F.col("row_nr").cast(dict(segments.dtypes)["row_nr"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = Scan(*shared.value)
        for b in batches:
            read = scan.read_all(b["text"].tolist(), [_page_of(p, i) for p, i in zip(b["page"], b["id"])])
            yield pd.DataFrame([(k, t, sorted(d)) for k, (d, t) in zip(b["row_nr"], read)], columns=["row_nr", "text", "damage"])

    return rows.mapInPandas(run, "row_nr string, text string, damage array<string>").withColumn("row_nr", key)
