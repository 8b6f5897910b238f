"""Personal data in free text: spans proposed by patterns, confirmed by check digits, weighed by the words around them.

Each kind has patterns with a base score. Check digits (Luhn, ISO 7064 mod 97 and mod 11,10, division by 11) raise or
settle it, words before and after raise or lower it, and a span is taken from ACCEPT on. Names are pairs of capitalised
words; a pair is weighed by whether it begins with a common given name and by what stands before and after it, and taken
whole after a role or title, before an act of speech, or right beside other personal data. A name found so is also taken
where else it stands in the same text. Where spans overlap, the higher score, then the longer, stays.

A text lies in one row: nothing is shuffled, and texts are read whole.

Defined results: null and empty texts hold nothing and are returned as they are; a null key is kept; repeated rows give
repeated results (found values are made distinct by key); empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCEPT = 0.5
KINDS = ("email", "address", "phone", "id_number", "name")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        k = int(c) * (1 + i % 2)
        total += k - 9 if k > 9 else k
    return total % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def mod11_10(digits: str) -> bool:
    p = 10
    for c in digits[:-1]:
        p = ((int(c) + p) % 10 or 10) * 2 % 11
    return (11 - p) % 10 == int(digits[-1])


def by_eleven(digits: str) -> bool:
    return int(digits) % 11 == 0


def _never(_: str) -> bool:
    return False


_GAP = r"(?:[^\S\n]*\n(?:> ?)?[^\S\n]*|[^\S\n]{1,3})"
_U, _L = "[A-ZÀ-ÖØ-ÞŁŚŠŽČŘĐ]", "[a-zß-öø-ÿłśšžčřđńęąćżźěů̀-ͯ]"
_CAP = rf"{_U}{_L}+"

_AT = r"(?:@|[^\S\n]{1,2}@[^\S\n]{1,2}|[^\S\n]{0,2}(?:\(at\)|\[at\]|\{at\}|<at>)[^\S\n]{0,2}|[^\S\n]AT[^\S\n])"
_DOT = r"(?:\.|[^\S\n]{0,2}(?:\(dot\)|\[dot\]|\{dot\}|<dot>)[^\S\n]{0,2}|[^\S\n]DOT[^\S\n])"
EMAIL = re.compile(rf"(?<![\w.+@-])[^\W_](?:[\w.+%-]*\w)?{_AT}(?:[^\W_](?:[\w-]*[^\W_])?{_DOT})+[^\W\d_]{{2,12}}(?![\w@])")

PHONES = [
    (0.7, re.compile(r"(?<![\w.+/@-])(?<!\d )(?:\+|00)[1-9]\d{0,2}[ .\-\xa0]?(?:\(0\)[ \xa0]?)?\d(?:[ .\-\xa0]?\d){6,11}(?!/)(?![\w@])")),
    (0.6, re.compile(r"(?<![\w.+/@-])(?<!\d )\(\d{3}\)[ \xa0]?\d{3}[-. ]\d{4}(?!\w)")),
    (0.6, re.compile(r"(?<![\w.+/@-])(?<!\d )[2-9]\d{2}([.-])\d{3}\1\d{4}(?![\w-])")),
    (0.6, re.compile(r"(?<![\w.+/@-])(?<!\d )0\d{2,4}/\d{4,8}(?:-\d{1,5})?(?!\w)")),
    (0.6, re.compile(r"(?<![\w.+/@-])(?<!\d )0\d{2,4}[ \xa0]\d{3,4}[ \xa0]\d{4}(?!\w)")),
    (0.6, re.compile(r"(?<![\w.+/@-])(?<!\d )07\d{3}[ \xa0]?\d{3}[ \xa0]?\d{3}(?![\w/-])")),
    (0.6, re.compile(r"(?<![\w.+/@-])(?<!\d )0[1-9](?:([ .\xa0])\d{2})(?:\1\d{2}){3}(?!\w)")),
]
_PHONE_NEAR = re.compile(r"(?i)(?:phone|tel|fax|voice|call|reach|mobile|ring|dial|text me|whatsapp|handy|m[óo]vil|portable|rufnummer|erreichbar|joignable|appel|t[ée]l)[^\n]{0,14}$")

IDS: list[tuple[float, re.Pattern[str], Callable[[str], bool]]] = [
    (0.6, re.compile(r"(?<![\w.-])[A-Z]{2}[ \xa0]?\d{2}[ \xa0]?\d{2}[ \xa0]?\d{2}[ \xa0]?[A-D](?!\w)"), _never),
    (0.5, re.compile(r"(?<![\w./-])\d{6}/\d{4}(?![\w/-])"), by_eleven),
    (0.5, re.compile(r"(?<![\w./-])\d{6}-\d{4}(?![\w/-])"), luhn),
    (0.5, re.compile(r"(?<![\w./-])\d{3}-\d{2}-\d{4}(?![\w/-])"), _never),
    (0.5, re.compile(r"(?<![\w.,/-])\d{2}[ \xa0]\d{3}[ \xa0]\d{3}[ \xa0]\d{3}(?![\w,])"), mod11_10),
    (0.6, re.compile(r"(?<![\w.-])[A-Z]\d[A-Z]\d{2}[A-Z]\d[A-Z]\d(?!\w)"), _never),
    (0.6, re.compile(r"(?<![\w.-])[A-Z]\d[A-Z]\d-\d{5}-[A-Z0-9](?!\w)"), _never),
    (0.1, re.compile(r"(?<![\w.-])[A-Z]{2}\d{2}(?:[ \xa0]?[A-Z0-9]{4}){2,7}(?:[ \xa0]?[A-Z0-9]{1,3})?(?!\w)"), mod97),
    (0.0, re.compile(r"(?<![\w.+-])[2-6](?:[ \xa0-]?\d){12,18}(?![\w-])"), luhn),
    (0.0, re.compile(r"(?<![\w.+/-])\d{11}(?![\w/-])"), mod11_10),
]
_ID_NEAR = re.compile(r"(?i)(?:\bid\b|identi|passport|passeport|pass-?nr|tax|steuer|social security|security n|personenkenn|ausweis|national|insurance|versicherung|num[ée]ro)[^\n]{0,24}$")
_NOT_PERSONAL = re.compile(r"(?i)(?:invoice|series|ballot|reference|aktenzeichen|\boid\b|object identifier|objektkennung|digest|version|contribution|beitrag|isbn|issn|serial|retention|dossier)[^\n.]{0,16}$")

_NUM = r"\d{1,4}(?:[^\S\n]?[a-d](?![\w]))?"
_TOWN = rf"(?:(?:Nether|Upper|Lower|Great|Little|New|Old|North|South|East|West|Port|Sankt|Saint|St\.|Bad|San|Santa|Mont|Le|La)[^\S\n])?{_CAP}(?:-(?:{_CAP}|{_L}{{1,3}}))*"
_TAIL = rf"(?:,?{_GAP}\d{{5}}{_GAP}{_TOWN}|,?{_GAP}{_TOWN}{_GAP}\d{{5}}(?!\w))?"
_SOUTH, _OF = r"(?:Calle|Avenida|Plaza|Paseo|Via|Viale|Piazza|Corso|Rua|Praça|Largo)", r"(?:(?:de la|de las|de los|del|de|di|della|dei|da|do|dos)[^\S\n])?"
_END = rf"(?:,?{_GAP}\d{{4,5}}{_GAP}{_TOWN}|,{_GAP}{_TOWN}(?:{_GAP}\d{{4,5}}(?!\w))?)?"
ADDRESSES = [
    re.compile(rf"(?<![\w.]){_NUM}{_GAP}(?:{_CAP}{_GAP}){{1,2}}(?:Street|Road|Lane|Avenue|Drive|Square|Terrace|St\.|Rd\.|Ave\.)(?!\w){_TAIL}"),
    re.compile(rf"(?<!\w)(?:{_CAP}[^\S\n])(?:Avenue|Street|Road|Lane|Drive|Square){_GAP}{_NUM}(?![\w]){_TAIL}"),
    re.compile(rf"(?<!\w){_CAP}(?:straße|strasse|str\.|weg|gasse|allee|platz|damm|ufer){_GAP}{_NUM}(?![\w]){_TAIL}"),
    re.compile(rf"(?<![\w.])\d{{1,4}}(?:[^\S\n](?:bis|ter))?,?{_GAP}(?:rue|avenue|boulevard|place|chemin|quai|impasse){_GAP}(?:(?:des|de la|de|du)[^\S\n]|de l['’]|d['’])?{_CAP}{_TAIL}"),
    re.compile(rf"(?<![\w.])\d{{1,4}},?{_GAP}{_SOUTH}{_GAP}{_OF}{_CAP}(?:{_GAP}{_CAP})?{_END}"),
    re.compile(rf"(?<!\w){_SOUTH}{_GAP}{_OF}{_CAP}(?:{_GAP}{_CAP})?,?{_GAP}(?:n[.º°]?[^\S\n]?)?\d{{1,4}}(?!\w){_END}"),
]
#: One of these stands in every address; the patterns are only tried around them.
_STREETS = ("Street", "Road", "Lane", "Avenue", "Drive", "Square", "Terrace", "St.", "Rd.", "Ave.", "straße", "strasse", "str.", "weg", "gasse", "allee", "platz", "damm", "ufer", "rue", "avenue", "boulevard", "place", "chemin", "quai", "impasse", "Calle", "Avenida", "Plaza", "Paseo", "Via", "Piazza", "Corso", "Rua", "Praça", "Largo")

_GIVEN = rf"{_CAP}(?:-{_CAP})?"
_SUR = rf"(?:(?:van der|van den|van|von|de|da|di|du|la|le)[^\S\n])?{_U}(?:['’]{_U})?{_L}+(?:-{_CAP})?"
_UPPER = rf"{_U}{{3,}}(?:-{_U}{{3,}})?"
_NAME = rf"(?:{_UPPER}{_GAP}{_GIVEN}|{_SUR},{_GAP}(?:{_GIVEN}(?:{_GAP}{_U}\.)?|(?:{_U}\.[^\S\n]?){{1,2}})|{_GIVEN}{_GAP}{_UPPER}(?!\w)|{_GIVEN}(?:{_GAP}{_U}\.)?{_GAP}{_SUR}|(?:{_U}\.(?:-{_U}\.)?[^\S\n]?){{1,2}}{_GAP}?{_SUR})(?!\w)"
_TITLE = r"(?:Dr\.|Prof\.|Mr\.?|Mrs\.?|Ms\.?|Herrn?|Frau|M\.|Mme|Mlle|Monsieur|Madame)"
#: Words after which a name follows, and words that follow a name.
_BEFORE = (
    "raised by", "for the secretariat:", "apporteur:", "apporteurs:", "apporteur :", "apporteurs :", "Berichterstattung:", "Action on", "he delegate", "stammt von", "vient de", "Anwesend:", "résent :", "résents :",
    "secrétariat :", "Le délégué", "La déléguée", "Der Delegierte", "Die Delegierte", "Maßnahme für", "Aufgabe für", "Action pour", "Dr.", "Prof.", "Mr", "Mr.", "Mrs", "Mrs.", "Ms", "Ms.", "Herr", "Herrn", "Frau", "M.", "Mme", "Mlle", "Monsieur", "Madame",
)
_AFTER = ("abstained", "asked for", "presented", "enthielt", "legte", "bat um", "stellte", "s'est", "s’est", "a présenté", "a demandé", "to prepare", ", the earlier", ", der frühere", ", le texte")
NAME_NEXT = re.compile(rf"(?:{_GAP}|)(?:{_TITLE}{_GAP})?({_NAME})")
NAME_LAST = re.compile(rf"(?<![^\W\d_])({_NAME}){_GAP}?$")
NAME_BESIDE = re.compile(rf"(?<![^\W\d_])({_NAME})[^\S\n]*(?:[|;<,(]|\n)[^\S\n]*[<(]?$")
#: Common given names that are hardly ever anything else at the head of two capitalised words.
GIVEN_NAMES = frozenset(
    "Adam Ahmed Alan Albert Alexander Alice Amanda Amy Ana Andrea Andreas Andrew Anna Anne Anthony Antonio Barbara Benjamin Bernd Brian Carla Carlos Caroline Catherine Charles Charlotte Christian Christina Christine "
    "Claire Claudia Daniel David Diana Donald Dorothy Edward Elena Elisabeth Elizabeth Emily Emma Eric Erika Eva Fatima Felix Fernando Frances Francisco Friedrich Gabriel Gary George Giovanni Giulia Giuseppe Gregory Hans "
    "Harold Heinrich Helen Helena Henry Ian Ingrid Isabel Isabelle Ivan Jacob Jacques James Jane Janet Jason Javier Jean Jeffrey Jennifer Jessica Johannes John Jonathan Jose Joseph Joshua José Juan Julia Julie Jürgen "
    "Karen Karin Karl Kate Katharina Katherine Kenneth Kevin Klaus Lars Laura Leon Linda Lisa Louise Lucas Lucia Luis Lukas Manuel Marc Marco Margaret Maria Marie Mario Marta Martin Mary Matthew Matthias Max Mehmet "
    "Michael Michelle Miguel Mohammed Monica Nancy Natalia Natalie Nicholas Nicole Nina Olga Oliver Olivier Pablo Patricia Patrick Paul Paula Pedro Peter Petra Philip Philippe Pierre Priya Rachel Rebecca Ricardo Richard "
    "Robert Roberto Roger Ronald Ruth Ryan Samuel Sandra Sara Sarah Sebastian Sharon Sofia Sophie Stefan Stephanie Stephen Steven Susan Teresa Thomas Timothy Ursula Vanessa Vincent Walter Werner William Wolfgang Yuki "
    "Yusuf".split()
)
_PAIR = re.compile(rf"(?<![^\W\d_])(?<![-'’])(({_CAP})(?:-{_CAP})?(?:{_GAP}{_U}\.)?{_GAP}{_SUR})(?![^\W\d_])(?!-\w)")
_SECOND = re.compile(rf"{_GAP}({_SUR})(?![^\W\d_])(?!-\w)")
_WEAK_BEFORE = re.compile(r"(?i)(?:\bcontact|\bmet|\bsigned,?|\bsincerely,?|\bregards,?|\bdear|\bthanks,?|\bspoke (?:to|with)|\basked|\btold|\bcalled|\bmy name is|\bi am|\bcolleague|\bwritten by|\bgrüße,?|\bgruß,?|\bcordialement,?|\bsaludos,?|\bliebe[r]?|\bcher|\bchère)[^\S\n]*\n?[^\S\n]*$")
_WEAK_AFTER = re.compile(r"[^\S\n]*,?[^\S\n]*(?:said|wrote|called|confirmed|agreed|told|joined|works|lives|replied|emailed|explained|thinks|wants|has been|sagte|schrieb|wohnt|arbeitet|a dit|a écrit|habite|dijo|escribió|vive)\b")
_NO_PERSON = re.compile(r"(?:^|[\s-])(?:Street|Road|Lane|Avenue|Square|Office|Ltd|GmbH|Inc|Corp|University|Institute|Hospital|School|Act|Protocol|Agreement|Committee|Group|Profile|Ledger|Annex|Table|Figure|Section|Clause|Standard|Service|System|Project|Working|Party|Union|Bank|Airport|Station|Church|Park|River|Lake|Mountain|Island|County|City)\b")
_LETTERS = re.compile(r"[\W_]+")


def value_of(mention: str) -> str:
    return _LETTERS.sub("", mention).lower()


_DIGITS = re.compile(r"\d[\dA-Z ()./\xa0-]{6,}")


def _places(text: str, needles: tuple[str, ...]) -> Iterator[tuple[int, int]]:
    """(begin, end) of every needle in text; far cheaper than one pattern of alternatives."""
    for n in needles:
        at = text.find(n)
        while at >= 0:
            yield at, at + len(n)
            at = text.find(n, at + 1)


def _proposals(text: str) -> Iterator[tuple[float, int, int, str]]:
    """Patterns run only in windows around what every match of theirs must contain."""
    for at, end in _places(text, ("@", "(at)", "[at]", "{at}", "<at>", " AT ")):
        for m in EMAIL.finditer(text, max(0, at - 70), min(len(text), end + 120)):
            if m.start() < at < m.end():
                yield 1.0, m.start(), m.end(), "email"
    for at, end in _places(text, _STREETS):
        low, high = max(0, at - 60), min(len(text), end + 90)
        for p in ADDRESSES:
            for m in p.finditer(text, low, high):
                if m.start() <= at and end <= m.end():
                    yield 0.9, m.start(), m.end(), "address"
    for chunk in _DIGITS.finditer(text):
        low, high = max(0, chunk.start() - 4), min(len(text), chunk.end() + 1)
        for base, p in PHONES:
            for m in p.finditer(text, low, high):
                before = text[max(0, m.start() - 32) : m.start()]
                yield base + 0.3 * bool(_PHONE_NEAR.search(before)) - 0.5 * bool(_NOT_PERSONAL.search(before)), m.start(), m.end(), "phone"
        for base, p, valid in IDS:
            for m in p.finditer(text, low, high):
                before = text[max(0, m.start() - 48) : m.start()]
                plain = re.sub(r"[\s/-]", "", m.group())
                confirmed = valid(plain) and len(set(plain)) > 1
                yield base + 0.8 * confirmed + 0.3 * bool(_ID_NEAR.search(before)) - 0.5 * bool(_NOT_PERSONAL.search(before)), m.start(), m.end(), "id_number"


def _resolve(spans: list[tuple[float, int, int, str]]) -> list[tuple[float, int, int, str]]:
    kept: list[tuple[float, int, int, str]] = []
    for s in sorted(spans, key=lambda s: (-s[0], s[1] - s[2], s[1], s[3])):
        if all(s[2] <= k[1] or s[1] >= k[2] for k in kept):
            kept.append(s)
    return sorted(kept, key=lambda s: s[1])


def _weighed_names(text: str) -> Iterator[tuple[float, int, int, str]]:
    """Pairs of capitalised words whose given name and neighbours weigh enough; a rejected first word frees the second."""
    m = _PAIR.search(text)
    while m:
        a, b = m.span(1)
        if m.group(2) in GIVEN_NAMES:
            second = _SECOND.match(text, b)
            if second and m.group(1).split()[-1] in GIVEN_NAMES:
                b = second.end(1)
        elif not _WEAK_AFTER.match(text, b):  # what stands before can't suffice alone
            m = _PAIR.search(text, m.end(2))
            continue
        before, after = _WEAK_BEFORE.search(text[max(0, a - 24) : a]), _WEAK_AFTER.match(text, b)
        other = _NO_PERSON.search(text[a:b]) or _NO_PERSON.match(text[b : b + 16].lstrip(" "))
        score = 0.2 + 0.35 * (m.group(2) in GIVEN_NAMES) + 0.2 * bool(before) + 0.15 * bool(after) - 0.4 * bool(other)
        if score >= ACCEPT:
            yield score, a, b, "name"
        m = _PAIR.search(text, b if score >= ACCEPT else m.end(2))


def find_personal(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of the personal data in text, in order and without overlaps."""
    spans = [s for s in _proposals(text) if s[0] >= ACCEPT]
    names = []
    for _, end in _places(text, _BEFORE):
        if m := NAME_NEXT.match(text, end):
            names.append((0.9, *m.span(1), "name"))
    for at, _ in _places(text, _AFTER):
        if m := NAME_LAST.search(text, max(0, at - 60), at):
            names.append((0.8, *m.span(1), "name"))
    for _, at, _, _ in spans:
        if m := NAME_BESIDE.search(text, max(0, at - 60), at):
            names.append((0.7, *m.span(1), "name"))
    names += _weighed_names(text)
    known = {text[a:b] for _, a, b, _ in names}
    for k in known:
        at = text.find(k)
        while at >= 0:
            if not (text[at - 1 : at].isalnum() or text[at + len(k) : at + len(k) + 1].isalnum()):
                names.append((0.6, at, at + len(k), "name"))
            at = text.find(k, at + 1)
    return [(a, b, kind) for _, a, b, kind in _resolve(spans + names)]


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, last = [], 0
    for a, b, kind in spans:
        out += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def found_values(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, value), distinct."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = {(k, kind, value_of(t[a:z])): None for k, t in zip(b["doc_id"], b["text"]) for a, z, kind in find_personal(t)}
            yield pd.DataFrame(list(got), columns=["doc_id", "kind", "value"])

    kind = dict(docs.dtypes)["doc_id"]
    # keys travel as strings: pandas would turn whole numbers beside nulls into floats
    rows = docs.where(F.length("text") > 0).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id string, kind string, value string").withColumn("doc_id", F.col("doc_id").cast(kind)).distinct()


def redacted(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_found): every document, its personal data replaced by [EMAIL], [PHONE] and so on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            spans = [find_personal(t) if t else [] for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [redact(t, s) if s else t for t, s in zip(b["text"], spans)], "n_found": [len(s) for s in spans]})

    kind = dict(docs.dtypes)["doc_id"]
    out = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, "doc_id string, text string, n_found int")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
