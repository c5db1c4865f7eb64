import os
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import mixing, names, noise, packing, quality, splitting, tokens

sys.path.insert(0, os.path.dirname(__file__))

CHUNK = "id string, chunk_text string, doc_type string, report_id string, chunk_index int, created_at string, extra string"


# Splitting


def rebuild(pieces, overlap):
    out = ""
    for text in pieces:
        k = min(overlap, len(out))
        assert text[:k] == out[len(out) - k :]
        out += text[k:]
    return out


def test_split(spark):
    rnd = random.Random(1)
    texts = ["", "short.", "x" * 95, "One two. " * 30, "para one.\n\n" + "word " * 30 + "\n \n" + "End. " * 9, "a\n\n" * 60, "é" * 50 + " " + "日本" * 40, "  \n\n" * 30, "😀" * 77]
    texts += ["".join(rnd.choice(["a", "bc ", ". ", "\n\n", " \n \n", "x" * 12]) for _ in range(rnd.randrange(200))) for _ in range(30)]
    rows = [(f"i{k}", t, "d", "r", k, "1", None) for k, t in enumerate(texts)] + [("n", None, "d", "r", 99, "1", None), ("o", "y" * 90, "other", "r", 100, "1", None), ("p", "y" * 90, None, "r", None, None, None)]
    chunks = spark.createDataFrame(rows, CHUNK)
    limits = spark.createDataFrame([("d", 40, 8), ("z", None, 1), (None, 3, 1)], "doc_type string, max_chars int, overlap_chars int")
    got = splitting.split_oversized(chunks, limits, block=7).orderBy("chunk_index").collect()
    assert [r.chunk_index for r in got] == list(range(len(got)))
    for k, t in enumerate(texts):
        mine = [r.text for r in got if r.id == f"i{k}"]
        assert all(len(p) <= 40 for p in mine) and rebuild(mine, 8) == t and (len(t) > 40) == (len(mine) > 1)
    assert [r.text for r in got if r.id in "nop"] == [None, "y" * 90, "y" * 90]


def test_split_boundaries_and_repeats(spark):
    rows = [("a", "p" * 30 + "\n\n" + "q" * 30, "d", "", 5, "1", None), ("b", "s" * 20 + ". " + "t" * 30, "d", "r", 0, "1", None), ("c", "w" * 30 + " " + "v" * 30, "d", "r", 1, "1", None), ("e", "x" * 41, "d", "r", 2, "1", None), ("e", "x" * 41, "d", "r", 2, "2", None)]
    chunks = spark.createDataFrame(rows, CHUNK)
    limits = spark.createDataFrame([("d", 40, 5)], "doc_type string, max_chars int, overlap_chars int")
    assert {tuple(r) for r in splitting.oversized(chunks, limits).collect()} == {("a", "paragraph"), ("b", "sentence"), ("c", "word"), ("e", "none")}
    assert splitting.split_oversized(chunks, limits).where("id = 'e'").count() == 2
    assert splitting.split_oversized(chunks.limit(0), limits).count() == 0 and splitting.oversized(chunks.limit(0), limits).count() == 0


def test_boundary_is_the_weakest_cut(spark):
    import re

    rnd = random.Random(12)
    make = lambda: "".join(rnd.choice(["abc ", "de. ", "\n\n", "x" * rnd.randrange(1, 14), "\n" + " " * 30 + "\n", "! ", "\n", "   ", "é? "]) for _ in range(rnd.randrange(5, 40)))
    rows = [(f"i{k}", make(), "d", None, None, None, None) for k in range(400)]
    chunks, limits = spark.createDataFrame(rows, CHUNK), spark.createDataFrame([("d", 12, 3)], "doc_type string, max_chars int, overlap_chars int")

    def level(t):
        paragraphs = [p.strip() for p in re.split(r"\n\s*\n", t)]
        sentences = [x.strip() for p in paragraphs for x in re.split(r"(?<=[.!?])\s+", p)]
        fits = lambda units: max(map(len, units), default=0) <= 12
        return "paragraph" if fits(paragraphs) else "sentence" if fits(sentences) else "word" if fits(t.split()) else "none"

    got = dict(map(tuple, splitting.oversized(chunks, limits).collect()))
    assert got == {i: level(t) for i, t, *_ in rows if len(t) > 12} and len(set(got.values())) == 4
    pieces = splitting.split_oversized(chunks, limits).collect()
    for i, t, *_ in rows:
        mine = [r.text for r in sorted((r for r in pieces if r.id == i), key=lambda r: r.piece_no)]
        assert all(len(p) <= 12 for p in mine) and rebuild(mine, 3) == t


def test_rows_without_index_and_exact_repeats(spark):
    rows = [(f"n{k}", "y" * 50, "d", "r", None, "1", None) for k in range(40)] + [("a", "one. two", "d", "r", 1, "1", None)] * 3 + [(None, "lone", "d", None, None, None, None)] * 2
    limits = spark.createDataFrame([("d", 40, None)], "doc_type string, max_chars int, overlap_chars int")
    got = splitting.split_oversized(spark.createDataFrame(rows, CHUNK), limits).collect()
    mine = sorted((r.chunk_index, r.id) for r in got if r.report_id == "r")
    assert [k for k, _ in mine] == list(range(81)) and mine[0][1] == "a" and [r.text for r in got if r.id is None] == ["lone"]


# Tokens, packing, mixing


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z9.'\n\t é日—😀,-"), max_size=60))
def test_tokens_of_pieces_are_those_of_the_text(text):
    counter = _counter()
    assert counter.count(text) == len(counter.encode(text))


_made: list = []


def _counter():
    if not _made:
        _made.append(tokens.Counter(tokens.VOCABULARY))
    return _made[0]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, extra string")


def test_assign():
    rnd = np.random.default_rng(1)
    sizes = np.sort(rnd.integers(1, 101, 500))[::-1]
    at = packing.assign(sizes, 100)
    load = np.bincount(at, sizes)
    assert load.max() <= 100 and (at >= 0).all() and len(load) <= 1.06 * sizes.sum() / 100 + 1
    assert len(packing.assign(np.array([], dtype=int), 10)) == 0
    cost = np.bincount(at, sizes + packing.QUADRATIC * sizes.astype(float) ** 2)
    assert cost[:-2].std() < 0.05 * cost.mean()


def test_pack(spark):
    rnd = random.Random(3)
    rows = [(k, "gold vein " * rnd.randrange(1, 90), "s", None) for k in range(80)] + [(200, None, "s", None), (201, "", "s", None), (5, "gold vein " * 7, "s", None), (None, "lost row", None, None)]
    spec = spark.createDataFrame([(1, 16), (2, 64), (3, None), (4, 0)], "container_id int, capacity_tokens int")
    d = docs(spark, rows)
    got = packing.pack(d, spec, shard=20).toPandas()
    assert set(got.container_id) == {1, 2}
    total = sum(_counter().count(t) for _, t, _, _ in rows if t)
    for cap, own in got.groupby("capacity_tokens"):
        assert own.n_tokens.sum() == total and own.groupby("container").n_tokens.sum().max() <= cap
        for _, c in own.sort_values("start_at").groupby("container"):
            assert list(c.start_at) == [0, *c.n_tokens.cumsum()[:-1]]
        once = own[own.groupby("doc_id").part_no.transform("max") == 0]
        assert (once.token_from == 0).all() and (own[own.n_tokens < cap].groupby(["doc_id", "token_from"]).size() <= 2).all()
    again = packing.pack(d.repartition(7), spec, shard=20).toPandas()
    assert sorted(map(str, got.itertuples(index=False))) == sorted(map(str, again.itertuples(index=False)))
    assert packing.pack(d.limit(0), spec).count() == 0
    assert all(r.fill > 0.8 for r in packing.fill(packing.pack(d, spec)).collect())


def test_solve_ends_where_no_number_is_near(spark):
    """Rates jump past a target where all documents of a source are of one length: the bracket closes, and no round is the last by count."""
    cells = spark.createDataFrame([("a", 10, 0, 7), ("b", 1, 0, 3), ("b", 400, 0, 2)], "source string, n_tokens int, part int, n long")
    goals = [{"goal": k, "source": s, "tilt": 0.0, "repeats": r, "mean": m, "target": t} for k, (s, r, m, t) in enumerate([("a", 3, 10.0, 123.456), ("b", 2, 160.6, 801.0), ("b", 5, 160.6, 0.5)])]
    for g in mixing.solve(cells, goals):
        assert g["done"] and abs(g["tilt"]) < 1e6


def test_mix(spark):
    rnd = random.Random(4)
    rows = [(k, "gold vein " * rnd.randrange(1, 30), rnd.choice("aaaaabbc"), None) for k in range(900)] + [(1, None, "a", None), (2, "x", None, None)]
    want = [(1, "a", 0.5, 1), (1, "b", 0.3, 2), (1, "c", 0.2, 3), (2, "a", 0.9, 1), (2, "none", 0.1, 2), (3, "c", None, 1), (3, "c", 0.5, 0)]
    targets = spark.createDataFrame(want, "mix_id int, source string, target_share double, max_repeats int")
    copies, shares = mixing.mix(docs(spark, rows), targets)
    got = {(r.mix_id, r.source): r for r in shares.collect()}
    for (m, s), r in got.items():
        if (m, s) in {(1, "a"), (1, "b"), (1, "c")}:
            assert abs(r.share - r.target_share) < 0.02 and abs(r.tokens - r.target_tokens) < 0.02 * r.target_tokens + 60
    assert got[(2, "none")].tokens == 0 and got[(2, "a")].share == 1.0 and got[(3, "c")].tokens == 0
    c = copies.collect()
    assert all(1 <= r.copies <= {(m, s): n for m, s, _, n in want}[(r.mix_id, r.source)] for r in c)
    assert min(got[(1, s)].target_tokens / (n * got[(1, s)].source_tokens) for s, n in (("a", 1), ("b", 2), ("c", 3))) <= 1.0
    empty = mixing.mix(docs(spark, rows).limit(0), targets)
    assert empty[0].count() == 0 and empty[1].count() == 7


# Names


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_lcs(a, b):
    best = max((len(s) for k in range(1 << len(a)) for s in ["".join(c for i, c in enumerate(a) if k >> i & 1)] if _inside(s, b)), default=0)
    assert names.lcs_ratio(a, b) == (2 * best / (len(a) + len(b)) if a or b else 1.0)


def _inside(s, t):
    it = iter(t)
    return all(c in it for c in s)


GROUPS = [
    ["Vantreil Lake Gold Mines Limited", "VANTREIL LK. GOLD MNS LTD", "Gold Mines of Vantreil Lake Ltd.", "Vantriel Lake Gold Mines", "Vantreil Lake (Gold) Corp. (operator)"],
    ["Vantreil River Gold Mines Ltd."], ["Lathis Uranium Ltd.", "Lauths Uran."], ["Lathis Copper Inc.", "The Lathis Cu Inc"], ["1876000 Quebec Inc.", "No. 1876000 Que. Inc.", "1876000-Quebec"], ["1876100 Quebec Inc."],
    ["Edward Mesforn", "MESFORN, ED", "E. Mesforn", "Mr. Mesforn Edward"], ["Gérard N. Mesforn", "Mesforn, Gerry", "G. Mesforn"], ["Bourmere & Zustmoultard Ventures Corp", "Bormere and Zustmoultard Vent."],
]


def test_names(spark):
    nobody = ["unknown", "n/a", "-", " ", "", None, "various owners", "see title page"]
    rows = [(v, "x") for g in GROUPS for v in g for _ in range(2)] + [(v, None) for v in nobody]
    got = {tuple(r) for r in names.linked_pairs(spark.createDataFrame(rows, "company string, extra string")).collect()}
    assert got == {(a, b) for g in GROUPS for a in g for b in g if a < b}
    assert names.linked_pairs(spark.createDataFrame([], "company string")).count() == 0


def test_errors_in_the_first_letter_and_ambiguous_short_forms(spark):
    groups = [["Vantreil Lake Gold Mines Ltd.", "Cantreil Lake Gold Mines Ltd.", "antreil Lake Gold Mines Ltd.", "Avntreil Lake Gold Mines"], ["Bell Point Gold Ltd.", "Bell Pt Gold"], ["Grolt Platinum Mines Inc.", "Grolt Pt Mines"], ["Cantreil River Gold Mines Ltd."]]
    got = {tuple(r) for r in names.linked_pairs(spark.createDataFrame([(v,) for g in groups for v in g], "company string")).collect()}
    assert got == {(a, b) for g in groups for a in g for b in g if a < b}


def test_general_words_are_learned(spark):
    rnd = random.Random(4)
    root = lambda: "".join(rnd.choice(["bra", "klu", "ston", "mer", "voi", "gret", "hul"]) for _ in range(3))
    roots = sorted({root() for _ in range(90)})
    values = [f"{r.title()} {w}" for r in roots for w in ("Drilling Ltd", "Drilling", "Partners Inc.", "Mns Ltd", "Drill Inc")] + [f"Vantreil Number {k}" for k in range(99)]
    df = spark.createDataFrame([(v,) for v in values], "company string")
    assert names.general_words(df) == {"drilling", "partners"}  # Vantreil and Number stand beside each other only
    got = {tuple(r) for r in names.linked_pairs(df.where("company NOT LIKE 'Vantreil%'")).collect()}
    assert {(a, b) for a, b in got} >= {tuple(sorted((f"{r.title()} Drilling", f"{r.title()} {w}"))) for r in roots for w in ("Drilling Ltd", "Drill Inc")}
    assert not any("Drilling" in a and "Partners" in b for a, b in got)


def test_words_of_a_common_block_all_meet(spark):
    rnd = random.Random(5)
    for _ in range(3):
        words = {"grethuroe", "grethuvre"} | {"g" + "".join(rnd.choice("abcdefhijkl") for _ in range(rnd.randrange(4, 40))) + "e" for _ in range(150)}
        for w in sorted(words)[:60]:
            m = list(w[1:-1])
            for _ in range(rnd.randrange(1, 4)):
                k = rnd.randrange(len(m))
                m[k : k + 1] = rnd.choice([[], [m[k], "z"], ["z"]])
            words.add("g" + "".join(m) + "e")
        words = sorted(w for w in words if len(w) >= 4)
        parsed = spark.createDataFrame([(w, "person", [w], "", "", []) for w in words], "company string, kind string, roots array<string>, place string, trade string, given array<string>")
        got = {tuple(r) for r in names.root_links(parsed).collect()}
        ratios = {(a, b): names.lcs_ratio(a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) <= names.EDITS}
        assert got == {p for p, r in ratios.items() if r >= max(names.LIKE, 1 - names.EDITS / sum(map(len, p)) - 1e-9)}
        assert ("grethuroe", "grethuvre") in got and len(got) > 40


def test_keys_of_a_common_block_are_made_in_little_memory(spark):
    """A word of 22 letters has some 1,500 keys; those of 4,000 such words would take a Python worker more than half a GB."""
    rnd = random.Random(6)
    words = ["g" + "".join(rnd.choice("abcdefhijklmnopqrst") for _ in range(20)) + "e" for _ in range(4000)]
    words.append(words[0][:7] + "z" + words[0][7:])
    blocks = spark.createDataFrame([(w, "e~person~g") for w in words], "w string, key string").coalesce(1)

    def workers() -> list[Path]:
        java = {p.parent for p in Path("/proc").glob("[0-9]*/cmdline") if b"pyspark.daemon" in p.read_bytes()}
        return [p for p in java if os.access(p / "clear_refs", os.W_OK)]

    for p in workers():
        (p / "clear_refs").write_text("5")  # peaks of earlier tests
    assert names._near(blocks).collect() == [tuple(sorted((words[0], words[-1])))]
    peaks = [int(re.search(r"VmHWM:\s+(\d+)", (p / "status").read_text())[1]) / 1024 for p in workers()]
    assert peaks and max(peaks) < 400


def test_keys_of_words_are_not_broadcast(spark):
    """Spark takes them for as small as the words, whatever the words' number, and would collect them in the driver."""
    words = spark.createDataFrame([("grethuroe",), ("grethuvre",), ("rgethuroe",)], "w string")
    for pairs in (names._near(words.withColumn("key", F.lit("e~person~g"))), names._first_letters(words.distinct())):
        assert pairs.count() == 1
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[[rt]#", plan) and not re.search(r"BroadcastHashJoin \[[rt]#", plan)


def test_components(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "y")], "a string, b string")
    assert {r.w: r.label for r in names.components(pairs).collect()} == {**dict.fromkeys("abcde", "a"), "x": "x", "y": "x"}


def test_components_of_a_long_chain(spark):
    chain = ["a", *(f"z{k:03d}" for k in range(70, 0, -1))]
    pairs = spark.createDataFrame(list(zip(chain, chain[1:])), "a string, b string")
    assert {r.label for r in names.components(pairs).collect()} == {"a"}


# Noise


BODY = "the survey lines were cut at right angles and the anomaly was followed along the contact between the granite and the basalt"


def corpus():
    rows = [(f"c{k}", f"Introduction\n\n{BODY}.\nThe work was done in the {w} of the year.", f"r{k}") for k in range(60) for w in ("spring",)]
    noisy = "\n".join(["the survey lines were cut at right angles and the ano-", "  - 12 -  ", "KLINDIS PROPERTY 1987", "maly was followed along the c0ntact between the granite", "and the basalt. The work was done in the spring of 19g7.", "", "Introduction", "", "Granite 12 and basalt 40.", ""])
    return [*rows, ("n", noisy, "r1"), ("n", noisy, "r1"), ("e", "", "r2"), ("z", None, None), (None, BODY, "r")]


def test_noise(spark):
    chunks = spark.createDataFrame([(*r, "x") for r in corpus()], "id string, chunk_text string, report_id string, extra string")
    got = {tuple(r) for r in noise.find_noise(chunks).collect()}
    assert got == {("n", 0, "hyphen"), ("n", 1, "page_no"), ("n", 2, "header"), ("n", 3, "ocr"), ("n", 4, "ocr")}
    mended = [r.text for r in noise.repair(chunks).where("id = 'n'").orderBy("paragraph_no").collect()]
    assert mended == [f"{BODY}. The work was done in the spring of 1997.", "Introduction", "Granite 12 and basalt 40."]
    assert noise.find_noise(chunks.limit(0)).count() == 0 and noise.repair(chunks.limit(0)).count() == 0


def test_readers_of_two_corpora_do_not_mix(spark):
    """Workers live on from query to query: each must read with its own lexicon."""
    words = [("the granite was followed along the northern contact", "granite", "granitc"), ("une veine recoupe les roches dans le secteur nord", "secteur", "sectcur")]
    made = []
    for text, word, wrong in words:
        rows = [(f"c{k}", f"{text} {k}.", f"r{k}") for k in range(40)] + [("n", f"{text.replace(word, wrong)} 1.", "r1")]
        made.append(spark.createDataFrame(rows, "id string, chunk_text string, report_id string").repartition(2))
    for _ in range(5):
        for chunks in made:
            assert {tuple(r) for r in noise.find_noise(chunks).collect()} == {("n", 0, "ocr")}


def test_a_line_is_a_header_if_it_runs(spark):
    body = [f"{BODY}." for _ in range(3)]
    page = lambda head: "\n".join([body[0], "", head, "", body[1], body[2]])
    rows = [(f"c{k}", BODY + ".", f"r{k}") for k in range(50)]
    rows += [("a", page("The Granite Was Followed"), "q"), ("b", page("North Survey Report"), "q"), ("c", page("North Surucy Report"), "q"), ("d", page("North Survey Report"), None), ("e", page("North Survey Report"), None)]
    rows += [("f", page("South Granite Report"), "q"), ("f", page("South Granite Report"), "q")]
    chunks = spark.createDataFrame(rows, "id string, chunk_text string, report_id string")
    assert {tuple(r) for r in noise.find_noise(chunks).collect()} == {("b", 2, "header"), ("c", 2, "header")}
    got = {(r.id, r.text) for r in noise.repair(chunks).collect()}
    assert ("a", "The Granite Was Followed") in got and ("d", "North Survey Report") in got and not {i for i, t in got if "Surucy" in t or t == "North Survey Report"} - {"d", "e"}


def test_repair_takes_one_row_of_an_id(spark):
    rows = [("a", f"{BODY}. Old.", "r", "1"), ("a", f"{BODY}. New.", "r", "2"), ("a", f"{BODY}. New.", "r", "2"), (None, f"{BODY}. One.", "r", None), (None, f"{BODY}. Two.", None, None), ("b", " ", "r", "1")]
    chunks = spark.createDataFrame(rows, "id string, chunk_text string, report_id string, created_at string")
    assert sorted((r.id or "", r.paragraph_no, r.text[-4:]) for r in noise.repair(chunks).collect()) == [("", 0, "One."), ("", 0, "Two."), ("a", 0, "New.")]


def test_words_broken_by_blanks_are_mended():
    words = {w: 1000 for w in (BODY + " con act").split()}
    reader = noise.Reader(words, frozenset(), sum(words.values()))
    for whole, broken in [("contact", "con tact"), ("contact", "c on tact"), ("granite", "gr an ite"), ("granite", "gran ite"), ("contact", "con act")]:
        text = BODY.replace(whole, broken)
        assert reader.repair(text) == [BODY if broken != "con act" else text] and reader.find(text) == ([(0, "ocr")] if broken != "con act" else [])
    for text in (BODY.replace("granite", "granite Ewan Grethuroe"), BODY.replace("granite", "con Grethuroe act"), BODY + ". Con Tact"):
        assert reader.repair(text) == [text]


def test_decoder_splits_and_merges():
    words = {w: 50 for w in BODY.split()}
    reader = noise.Reader(words, frozenset(), 2000)
    read = lambda s: [w for _, _, w, _ in reader.decode(s)]
    assert read("ano\x1fmaly") == ["anomaly"] and read("ano maly") == ["anomaly"] and read("surveylines") == ["survey", "lines"] and read("anornaly") == ["anomaly"]
    assert reader.decode("survey") == [(0, 6, "survey", False)]
    assert read("x" * 5000) == ["x" * 5000] and read("Grethuroe and") == ["Grethuroe", "and"] and read("") == []


def test_the_whole_stream_is_decoded_jointly():
    """Words that begin in one token and end in another, over blanks, line ends and hyphens."""
    words = {w: 500 for w in BODY.split()}
    reader = noise.Reader(words, frozenset(), sum(words.values()))
    text = BODY.replace("the contact between", "theconta ct betw-\neen").replace("survey lines", "surveylines").replace("anomaly was", "ano maIy was").replace("followed along", "foll owedalong")
    assert reader.repair(text) == [BODY]
    assert sorted(reader.find(text)) == [(0, "hyphen"), (0, "ocr")]


def test_windows_read_as_the_whole_stream_does():
    rnd = random.Random(9)
    words = {w: 500 for w in BODY.split()}
    reader = noise.Reader(words, frozenset(), sum(words.values()))
    for _ in range(60):
        tokens = BODY.split()[: rnd.randrange(2, 12)]
        for _ in range(3):
            k = rnd.randrange(len(tokens))
            t = tokens[k]
            at = rnd.randrange(len(t))
            tokens[k : k + 1] = rnd.choice([[t[:at], t[at:]], [t[:at] + rnd.choice("xe1") + t[at + 1 :]], [t]])
            tokens = [x for x in tokens if x]
        whole = [w for _, _, w, _ in reader.decode(" ".join(tokens))]
        read, at = [], 0
        for a, b, word, _ in reader.read(tokens):
            read += [*tokens[at:a], word]
            at = b
        assert read + tokens[at:] == whole, tokens


def test_paragraphs_depend_on_their_own_width():
    reader = noise.Reader({w: 9 for w in BODY.split()}, frozenset(), 999)
    narrow = ["The survey lines were cut", "at right angles and the", "anomaly was followed.", "Northern granite was cut", "along the basalt."]
    wide = ["The survey lines were cut at right angles and the anomaly was followed along the contact", "between the granite and the basalt at right angles along the", "contact."]
    lines = [*narrow, "", *wide]
    got = reader.paragraphs(lines, reader.kinds(lines), [k for k, x in enumerate(lines) if x])
    assert got == [[0, 1, 2, 3, 4], [6, 7, 8]]
    short = ["The survey lines were cut at right angles and the anomaly was", "followed.", "The granite was cut along the basalt and the contact was", "followed at right angles."]
    assert reader.paragraphs(short, ["text"] * 4, [0, 1, 2, 3]) == [[0, 1], [2, 3]]


def test_repair_is_true_to_the_text():
    from fidelity import measure

    rnd = random.Random(8)
    words = BODY.split()
    texts = [[" ".join(["The", *(rnd.choice(words) for _ in range(40))]) + "." for _ in range(4)] for _ in range(30)]
    counted: dict = {}
    for p in texts:
        for w in " ".join(p).lower().replace(".", "").split():
            counted[w] = counted.get(w, 0) + 1
    reader = noise.Reader(counted, frozenset(), sum(counted.values()))
    got = measure(reader, texts)
    assert got["before"] > 0.004 and got["after"] < 0.1 * got["before"] and got["ends_found"] > 0.97 and got["ends_right"] > 0.97


# Quality


COMMON = [("en", w) for w in "the of and to a in is was that for it on".split()] + [("fr", w) for w in "le la les de des du et un".split()]
PROSE = "It was clear that the contact of the granite was to the north. The core was cut and sent to a laboratory for assay.\n"


def test_quality(spark):
    rnd = random.Random(6)
    texts = [(k, PROSE * rnd.randrange(1, 5) + f"In {k} it was found that the vein is {k} m wide.", None) for k in range(60)]
    odd = {
        100: ("list", "\n".join(f"- basalt map {k}" for k in range(20))), 101: ("list", "\n".join(f"Claim Status ......... {k}" for k in range(20))), 102: ("table", "\n".join(f"S{k}\t{k}\t{k * 2}" for k in range(20))),
        103: ("table", "\n".join(f"{k}.5  {k}.1   {k * 3}" for k in range(20))), 104: ("junk", "\n".join("".join(rnd.choice("#*<>=_^[]{}|~ab") for _ in range(40)) for _ in range(10))), 105: ("junk", "page blank\n" * 30), 106: ("junk", "BT /F1 6 Tf 1.2 3.4 Td <F7EF> Tj ET\n" * 9),
        107: ("junk", "kwzbb lfthbwhnqcbrhr sngrxnntmlhl frjfjg zxjtwqqtr xjqkxxwlfgfsqpqg\n" * 4), 108: ("list", "Contents:\n" + "- gold\n- silver map\n- Lake survey\n" * 9),
    }
    rows = texts + [(k, t, None) for k, (_, t) in odd.items()] + [(200, None, None), (201, "", None), (0, texts[0][1], None)]
    d, common = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(COMMON, "lang string, word string")
    assert {r.doc_id: r.kind for r in quality.flag(d, common).collect()} == {k: kind for k, (kind, _) in odd.items()}
    s = {r.doc_id: r for r in quality.statistics(d, common).collect()}
    assert s[200].words == 0 and s[200].language == "und" and s[0].language == "en" and s[102].row_share == 1.0 and s[100].item_share == 1.0
    assert quality.measure("─┼╬ █▀ text", [frozenset()])[11] == 2 and quality.measure("plain text", [frozenset()])[11] == 0
    for sign in ("Tf", "Ã©", "â€", "Â§", "\ufffd", "┼", "<b>"):
        assert quality.measure(f"some {sign} text", [frozenset()])[11] == 1
    q = {r.language: r.q.words for r in quality.distributions(quality.statistics(d, common)).collect()}
    assert q["und"] == q["fr"] != q["en"]  # few documents have no distribution of their own
    p = quality.percentiles(quality.statistics(d, common)).where("doc_id = 1").head()
    assert 0 <= p.p_common_share <= 100
    assert quality.flag(d.limit(0), common).count() == 0 and quality.flag(d, common.limit(0)).count() >= 0


def test_sketch_ranks_are_near_the_exact(spark):
    d = spark.range(5000).select(F.lit("en").alias("language"), *[F.col("id").cast("double").alias(s) for s in quality.STATS])
    q = quality.distributions(d).head().q
    assert all(abs(q["words"][k] - 50 * k) < 150 for k in range(101))


def test_no_language_is_dropped_silently(spark):
    documents = spark.createDataFrame([(1, "the word")], "doc_id long, text string")
    for n in (200, 201):
        common = spark.createDataFrame([(f"l{k:03d}", "the" if k == n - 1 else f"w{k}") for k in range(n)], "lang string, word string")
        if n > 200:
            with pytest.raises(ValueError, match="200 languages"):
                quality.statistics(documents, common)
        else:
            assert quality.statistics(documents, common).head().language == "l199"


@pytest.mark.parametrize("name", ["p1_found", "p1_repaired", "p2_found", "p2_pieces", "p3_found", "p3_entities", "p6_packed", "p6_fill", "p7_mixed", "p7_shares", "p8_found", "p8_stats"])
def test_queries_are_registered(name):
    from strata.llm import queries

    assert name in queries.QUERIES
