"""Problems 1, 2, 8 and 10."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausemill.llm import leakage, personal, repeated_lines, scanned

SEG = "row_nr long, id string, norm string, type string, page int, text string, source_file string"
LINE = "This document is provided for information only and carries no warranty"


def seg(row_nr, text, norm="N", kind="NORM", source="f1", page=1, key=None):
    return (row_nr, key or f"x_p{page}_b{row_nr}", norm, kind, page, text, source)


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(1)
    lines = [LINE, LINE.upper() + " (2)", "A sentence of some length that stands in a few of the documents only", "short"]
    rows = [seg(i, "\n".join(rng.choices(lines, k=3)), rng.choice(["A", "B", None]), rng.choice(["NORM", "TOC", None]), rng.choice(["f1", "f2", "f3", "f4", "f5", "f6", None])) for i in range(200)]
    rows += rows[:7]
    letters = lambda s: "".join(c for c in s.lower() if c.isalpha())
    docs = defaultdict(set)
    occ = []
    for r in rows:
        if r[3] in ("SECTION", "TOC") or r[2] is None:
            continue
        for n, line in enumerate(r[5].split("\n"), 1):
            if len(letters(line)) >= 45:
                occ.append((r[0], n, r[2], letters(line)))
                if r[6]:
                    docs[r[2], letters(line)].add(r[6])
    want = sorted((a, n) for a, n, norm, k in occ if len(docs[norm, k]) >= 5)
    got = sorted((r.row_nr, r.line_nr) for r in repeated_lines.find_repeated_lines(spark.createDataFrame(rows, SEG)).collect())
    assert got == want and want


def test_repeated_lines_are_removed_and_the_rest_stays(spark):
    rows = [seg(i, f"keep {i}\n{LINE}\nend", source=f"f{i}") for i in range(5)] + [seg(9, None), seg(10, ""), seg(11, "x" * 100_000)]
    df = spark.createDataFrame(rows, SEG).selectExpr("*", "1 AS letters", "2 AS n_docs", "3 AS ordinal")
    out = {r.row_nr: r for r in repeated_lines.remove_repeated_lines(df).collect()}
    assert out[0].text == "keep 0\nend" and out[0].n_removed == 1 and out[0].letters == 1
    assert out[9].text is None and out[10].text == "" and len(out[11].text) == 100_000 and out[11].n_removed == 0


def test_bitmap_cardinalities_are_exact_across_words(spark):
    rows = [seg(i, LINE + "!" * (i % 3), source=f"doc{i % 300:03}") for i in range(900)]
    assert [r.n_docs for r in repeated_lines.repeated_keys(spark.createDataFrame(rows, SEG)).collect()] == [300]


CATALOG = [("EN 301 001", "Field of things (FOT); Rules for sealed boxes")]


def scans(spark, rows):
    extra = [seg(10_000 + i, "the quorum shall retain every sealed ledger whenever the descriptor changes and handed copies") for i in range(200)]
    heads = [seg(20_000 + i, "EN 301 001 V1.2.3 (2024-01)", kind="HEADER") for i in range(20)]
    return spark.createDataFrame(rows + extra + heads, SEG), spark.createDataFrame(CATALOG, "norm string, title string")


def test_scan_damage_kinds_and_mended_text(spark):
    rows = [
        seg(1, "the quorum shall re-\ntain every sealed led¬\nger whenever", page=4),
        seg(2, "the quorum sha1l retain evcry ledger", page=4),
        seg(3, "the quorum shall retain every\n- 4 -\nsealed ledger whenever", page=4),
        seg(4, "the quorum shall retain every\n12    EN 301 001 V1.2.3 (2024-01)\nsealed ledger", page=4),
        seg(5, "the quorum shall retain every\nRULES FOR SEALED BOXES — WP Ab Cd\nsealed ledger", page=4),
        seg(6, "the long-\nterm quorum shall retain every ledger:\n6213\nhanded", page=4),
        seg(7, "hanc¬\nled copies", page=4),
        seg(8, "the quorum shall retain\n7\nevery sealed ledger", page=None, key="doc_p6_b1"),
    ]
    df, cat = scans(spark, rows)
    got = defaultdict(set)
    for r in scanned.scan_damage(df, cat).collect():
        got[r.row_nr].add(r.damage)
    assert dict(got) == {1: {"hyphen"}, 2: {"char"}, 3: {"page_nr"}, 4: {"header"}, 5: {"header"}, 7: {"hyphen", "char"}, 8: {"page_nr"}}
    text = {r.row_nr: r.text for r in scanned.mended_text(df, cat).collect()}
    assert text[1] == "the quorum shall retain every sealed ledger whenever"
    assert text[2] == "the quorum shall retain every ledger"
    assert text[3] == "the quorum shall retain every sealed ledger whenever"
    assert text[7] == "handed copies"
    assert text[6].startswith("the long-term quorum")


def test_words_count_however_many_are_commoner(spark):
    filler = ["".join(w) for w in itertools.product("xzkwymp", repeat=6)] + ["".join(w) for w in itertools.product("xzkwymp", repeat=7)][:100_000]
    rows = [seg(30_000 + i, " ".join(filler[i * 2000 : (i + 1) * 2000] * 3)) for i in range(len(filler) // 2000 + 1)]
    rows += [seg(i, "heptagon") for i in range(10, 13)] + [seg(1, "hepta-\ngon"), seg(2, "heptag0n"), seg(3, "gasket-\n- 1 -\nry")] + [seg(i, "gasketry") for i in range(13, 16)]
    df, cat = scans(spark, rows)
    assert len(filler) > 200_000
    assert {(r.row_nr, r.damage) for r in scanned.scan_damage(df, cat).collect()} == {(1, "hyphen"), (3, "hyphen"), (3, "page_nr")}


def test_halves_of_words_broken_twice_and_across_headers():
    lines = ["the re-", "- 4 -", "ta-", "in it"]
    classes = scanned.Layout(frozenset()).classes(lines, 4)
    assert {"reta", "retain", "tain"} <= scanned.halves(lines, classes)


def test_confusions_keep_the_key_and_are_counted(spark):
    pairs = list(scanned.CONFUSIONS) + [("sha1l", "shall"), ("rnodern", "modern"), ("8ox", "hox"), ("disclosure", "disdosure"), ("li" * 40, "h" * 40)]
    keys = spark.createDataFrame(pairs, "a string, b string").select(scanned.confusion_key(F.col("a")).alias("a"), scanned.confusion_key(F.col("b")).alias("b")).collect()
    assert all(k.a == k.b for k in keys)
    assert [scanned.confusions(a, b) for a, b in (("sha1l", "shall"), ("rnodern", "modern"), ("8ox", "hox"), ("1i", "h"), ("same", "same"), ("cat", "dog"), ("111111", "llllll"))] == [1, 1, 2, 2, 0, None, None]


def test_labels_are_those_of_the_best_paths():
    rng = np.random.default_rng(0)
    model = scanned.Lines(rng.normal(size=(sum(scanned.FEATURES), 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    sizes = np.array([5, 1, 3, 5, 2])
    feats = np.stack([rng.integers(0, n, sizes.sum()) for n in scanned.FEATURES], 1)
    score = model.weights[feats + scanned._FROM].sum(1)
    got, end = model.label(feats, sizes), 0
    for n in sizes:
        own, said = score[end : end + n], got[end : end + n]
        value = lambda p: model.begin[p[0]] + sum(own[i][s] for i, s in enumerate(p)) + sum(model.move[a][b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert value(said) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=int(n))))
        end += n
    assert model.label(np.zeros((0, len(scanned.FEATURES)), int), np.zeros(0, int)).size == 0


def test_the_model_finds_headers_that_their_form_does_not_show():
    titles = scanned.known_titles(["Field of things (FOT); Rules for sealed boxes; Part 1: Formats", "Data model for timed registers"])
    layout, words, rng = scanned.Layout(titles), scanned.title_words(titles), random.Random(2)
    vocab = "the quorum shall retain every sealed ledger whenever descriptor changes and handed copies of timed registers".split()

    def text():
        return "\n".join(" ".join(rng.choices(vocab, k=9)) + rng.choice(["", "", "."]) for _ in range(rng.randint(2, 7)))

    heads = [(rng.choice(["EN 301 001 V1.2.3 (2024-01)", "RULES FOR SEALED BOXES — WP Ab Cd", "Draft TS 101 456 V1.1.1", "DATA MODEL FOR TIMED REGISTERS"]), 3) for _ in range(60)]
    made = lambda n: scanned.training_sequences(heads, [(text(), rng.randint(2, 60)) for _ in range(n)], layout, words)
    model, held = scanned.Lines.fit(made(800)), made(400)
    feats, truth = (np.concatenate(x) for x in zip(*held))
    said = model.label(feats, np.array([len(y) for _, y in held]))
    head, form = truth == scanned.HEADER, np.isin(feats[:, 0], scanned._MARGIN)
    recall = lambda x: (x & head).sum() / head.sum()
    assert recall(said == scanned.HEADER) > 0.97 > recall(form) + 0.05 and ((said == scanned.HEADER) & ~head).sum() < 0.03 * head.sum()
    assert scanned.Lines.fit([]).label(feats[:2], np.array([2])).size == 2


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{chr(97 + i)}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocab, k=20))) for i in range(6)] + [(90, "too short"), (91, None)]
    docs = []
    for i in range(60):
        t = rng.choices(vocab, k=30)
        if i % 3 == 0:
            w = items[i % 6][1].split()
            k = rng.choice([11, 12, 15])
            t[5:5] = w[2 : 2 + k]
        docs.append((i, " ".join(t).upper() if i % 2 else ", ".join(t)))
    docs += [(100, None), (101, ""), docs[0]]
    grams = lambda t: {tuple(w[i : i + 12]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 11)}
    want = sorted((d, i) for d, t in set(docs) for i, u in items if grams(t) & grams(u))
    D, E = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, leakage.verbatim_leaks(D, E).collect()))
    assert got == want and want
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaked_pairs(D, E).where("n_exact > 0").collect()) == want


def test_reparameterised_questions(spark):
    item = "Although the witness counted 157 copies, Marta asked Jonas to seal the ledger 4 days before the ballot of the quorum closed."
    again = item.replace("157", "31").replace("4 days", "9 weeks").replace("Marta", "Edith").replace("Jonas", "Pavel").replace("copies", "octets")
    mixed = item.replace("157", "31").replace("Marta", "Edith", 1) + " " + item.replace("157", "99")
    docs = spark.createDataFrame([(1, again), (2, item), (3, mixed), (4, "nothing of the kind")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in leakage.reparameterised_leaks(docs, items).collect()] == [(1, 7)]
    assert [(r.doc_id, r.item_id) for r in leakage.verbatim_leaks(docs, items).where("doc_id = 2").collect()] == [(2, 7)]


def test_templates_do_not_depend_on_other_items(spark):
    item, again = ("The custodian %s must keep every sealed register of the old quorum for %d days" % x for x in (("Alice", 3), ("Robert", 40)))
    docs = spark.createDataFrame([(1, again), (2, item.upper())], "doc_id long, text string").selectExpr("*", "'v' AS v", "'w' AS w", "1L AS h")
    for more in ([], [(8, "write to alice at once"), (9, "robert robert " * 10)]):
        items = spark.createDataFrame([(7, item)] + more, "item_id long, text string")
        assert [(r.doc_id, r.item_id) for r in leakage.reparameterised_leaks(docs, items).collect()] == [(1, 7)]
        assert [tuple(r) for r in leakage.verbatim_leaks(docs, items).collect()] == [(2, 7)]
    assert leakage.leaked_pairs(docs.limit(0), items).count() == leakage.leaked_pairs(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Write to <ann.b@mail.site.example> soon.", [("email", "annbmailsiteexample")]),
        ("Write to ann (at) site (dot) example soon.", [("email", "annatsitedotexample")]),
        ("Tel. +44 (0)20 7946 0573", [("phone", "4402079460573")]),
        ("Call 030/23125-229 today", [("phone", "03023125229")]),
        ("Passport no. QQ 12 34 56 C was copied", [("id_number", "qq123456c")]),
        ("The schema seal@6.6.0 and @since(2026); OID 1.0.3.28.6; Ballot reference 313-20-313", []),
        ("Invoice series 0216296/73 is out of scope.", []),
        ("IBAN DE89 3704 0044 0532 0130 00 is real, DE88 3704 0044 0532 0130 00 is not", [("id_number", "de89370400440532013000")]),
        ("card 4111 1111 1111 1111 or 4111 1111 1111 1112", [("id_number", "4111111111111111")]),
        ("The holder lives at 24 Lantern Street, Sankt Meldau 11664 and was informed.", [("address", "24lanternstreetsanktmeldau11664")]),
        ("Zustellung an Orchardstr. 80,\n79799 Nether Quill.", [("address", "orchardstr8079799netherquill")]),
        ("at 117, rue des Lanterns, 01736 Vieux-Orval", [("address", "117ruedeslanterns01736vieuxorval")]),
        ("The comment was raised by Ulmwick, Edith.", [("name", "ulmwickedith")]),
        ("Dr. Vera-Maria Ulmwick presented the clause.", [("name", "veramariaulmwick")]),
        ("ULMWICK Vera abstained from the vote.", [("name", "ulmwickvera")]),
        ("Vera Ulmwick | +1-212-555-0137", [("name", "veraulmwick"), ("phone", "12125550137")]),
        ("The Quarry Ledger pilot ran for 4 weeks. Annex Copper stays.", []),
        ("", []),
    ],
)
def test_personal_data(text, want):
    assert [(k, personal.value_of(text[a:b])) for a, b, k in personal.find_personal(text)] == want


#: Sentences written by hand, none by the generator of the tables; what stands in braces is personal, by kind.
HELD_OUT = """Please contact {name:Jane Miller} in our London office.
I met {name:Robert Smith} yesterday at the station.
Signed, {name:Maria Gonzalez}
Kind regards,\n{name:Thomas Becker}
{name:Sarah O'Neill} wrote that the parcel had arrived.
My colleague {name:Ahmed Hassan} will be in touch; ring him on {phone:07700 900123}.
Liebe {name:Ursula Schneider}, anbei die Unterlagen.
{name:Sophie Laurent} habite {address:14 rue des Lilas, 75011 Paris}.
Send it to {email:josé.garcía@exämple.com} or {email:info@müller-bau.de}.
She moved to {address:12 Calle Mayor, Madrid} in May.
Il mio indirizzo è {address:Via Garibaldi 7, 00153 Roma}.
Wir wohnen in der {address:Lindenstraße 5, 10969 Berlin}.
Our new flat: {address:221 Baker Street}
Call {phone:+49 30 901820} or {phone:(212) 555-0187} before noon.
Dial {phone:020 7946 0958} and ask for {name:Peter van der Berg}.
Thanks, {name:Priya Sharma}
{name:Juan Carlos Ortega} confirmed the date.
The card {id_number:4012 8888 8888 1881} was declined.
Her SSN is {id_number:078-05-1120}.
IBAN: {id_number:GB82 WEST 1234 5698 7654 32}
My name is {name:Kofi Mensah}, pleased to meet you.
I spoke to {name:Elif Demir} said the clerk.
{name:William Shakespeare} has been dead for centuries.
{name:Dr. Ruth Adler} called twice.
Email {email:first.last+tag@sub.example.org}, please.
The letter was for {name:Yuki Tanaka}.
Meet {name:Elena Petrova} at noon.
The Baker Street office opens at nine.
San Francisco and New York are far apart.
Version 3.2.1 of Table 5 lists 12 345 678 items.
The United Nations Charter was signed in June.
Order number 20240917-0042 is late.
Thomas Street is closed for repairs.
Marie Curie University offers grants.
Working Party Two met in Great Hall.
Visit the Martin Luther Church on Sunday.
The ratio 10.5555/12345 is a made-up handle.
Paul Group and Adam Ltd have merged.
In Python, write x@y for a matrix product.
Room 101 Avenue of the Americas""".split("\n")


def test_personal_data_in_sentences_of_other_hands():
    hit = said = true = 0
    for line in HELD_OUT:
        line = line.replace("\\n", "\n")
        want = {(k, personal.value_of(re.sub(r"^Dr\\. ", "", v))) for k, v in re.findall(r"\{(\w+):([^}]+)\}", line)}
        plain = re.sub(r"\{\w+:([^}]+)\}", r"\1", line)
        got = {(k, personal.value_of(plain[a:b])) for a, b, k in personal.find_personal(plain)}
        hit, said, true = hit + len(got & want), said + len(got), true + len(want)
    print(f"of {true} true values {hit} found, of {said} found {hit} true")
    assert hit / true >= 0.85 and hit / said >= 0.9


def test_check_digits():
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")
    assert personal.mod97("DE89370400440532013000") and not personal.mod97("DE89370400440532013001")
    assert personal.mod11_10("86095742719") and not personal.mod11_10("86095742718")


def test_redaction_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, "Dear all, write to a.b@c.example. Bye"), (2, None), (3, ""), (None, "x" * 300_000)], "doc_id long, text string")
    out = {r.doc_id: r for r in personal.redacted(docs.selectExpr("*", "'k' AS kind", "'v' AS value")).collect()}
    assert out[1].text == "Dear all, write to [EMAIL]. Bye" and out[1].n_found == 1
    assert out[2].text is None and out[3].text == "" and len(out[None].text) == 300_000


def test_null_keys_leave_large_keys_exact(spark):
    big = 2**60 + 1
    text = "Write to a.b@c.example " + "one two three four five six seven eight nine ten eleven twelve thirteen " * 3
    docs = spark.createDataFrame([(big, text), (None, text)], "doc_id long, text string")
    items = spark.createDataFrame([(big, text), (None, "x")], "item_id long, text string")
    assert {r.doc_id for r in personal.found_values(docs).collect()} == {big, None}
    assert {(r.doc_id, r.item_id) for r in leakage.verbatim_leaks(docs, items).collect()} == {(big, big), (None, big)}
