"""SimHash components, line deduplication and decontamination."""

import random

import numpy as np
import pytest

from monthwise.llm import decontaminate, line_dedup, simhash

from .helpers import dedup_lines, documents, fingerprint, link_components


def test_golay_decodes_three_errors():
    golay = simhash.Golay()
    rng = np.random.default_rng(1)
    # every syndrome has its pattern, so a codeword and any 3 errors decode alike
    assert len(set(golay.error.tolist())) == 2048
    words = rng.integers(0, 1 << 23, 2000)
    first = golay.decode(words)
    for _ in range(3):
        near, keys = golay.fuzzy_keys(words)
        assert set(np.bincount(near).tolist()) <= {1, 6}
        assert {(int(r), int(k)) for r, k in zip(near, keys)} >= {(i, int(k)) for i, k in enumerate(first)}


@pytest.mark.parametrize("flips", [0, 1, 2, 3])
def test_tables_meet_up_to_three_errors(flips):
    rng = random.Random(flips)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), flips):
            b ^= 1 << bit
        (_, x), (_, y) = (simhash.bucket_keys(np.array([v], dtype=np.uint64)) for v in (a, b))
        assert set(x.tolist()) & set(y.tolist())


def test_every_split_of_three_errors_meets():
    rng = random.Random(9)
    segments = [range(0, 23), range(23, 46), range(46, 64)]
    for split in [(3, 0, 0), (0, 3, 0), (0, 0, 3), (2, 1, 0), (1, 2, 0), (2, 0, 1), (0, 2, 1), (1, 0, 2), (0, 1, 2), (1, 1, 1)]:
        for _ in range(60):
            a = b = rng.getrandbits(64)
            for segment, n in zip(segments, split):
                for bit in rng.sample(list(segment), n):
                    b ^= 1 << bit
            (_, x), (_, y) = (simhash.bucket_keys(np.array([v], dtype=np.uint64)) for v in (a, b))
            assert set(x.tolist()) & set(y.tolist()), split


def test_fingerprint_equals_definition():
    rng = random.Random(4)
    for n in [0, 1, 2, 3, 4, 50]:
        text = "\x0b ".join(rng.choice(["The", "cat", "Éa", "ß", "\xa0x", "run"]) for _ in range(n))
        assert simhash.fingerprint(text) == fingerprint(text)
    assert simhash.fingerprint(None) == 0


def test_long_text_is_counted_in_slices():
    text = " ".join(str(i) for i in range(70_000))
    assert simhash.fingerprint(text) == fingerprint(text)


def near_corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(150)]
        for copy in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(copy % 3):
                text[rng.randrange(150)] = word()
            rows.append((i * 3, " ".join(text)))
            i += 1
    return [*rows, (1, None), (4, ""), (7, " \t"), (10, "One"), (13, "one"), (16, "two words")]


def test_components_equal_brute_force(spark):
    rows = near_corpus()
    want = link_components({d: fingerprint(t) for d, t in rows})
    out = simhash.near_duplicates(documents(spark, rows, "fingerprint _fp _label _pick")).collect()
    assert {r.doc_id: r.component_id for r in out} == want
    assert all(r.fingerprint == format(fingerprint(dict(rows)[r.doc_id]), "016x") for r in out)
    assert len(set(want.values())) < len(rows) - 10


def test_chain_of_links_and_large_bucket(spark, monkeypatch):
    """A chain links its ends; a bucket dealt out in chunks loses no link."""
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = random.Random(6)
    fps, x = {}, rng.getrandbits(64)
    for i in range(60):  # neighbours differ in 2 bits, the ends in many
        fps[i] = x
        for bit in rng.sample(range(46, 64), 2):
            x ^= 1 << bit
    for i in range(60, 90):
        fps[i] = rng.getrandbits(64)
    rows = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in fps.items()], "doc_id long, _fp long")
    found = {r["_fp"]: r["_pick"] for r in simhash.components(rows, lambda c: simhash.F.min(c or "doc_id")).collect()}
    want = link_components(fps)
    assert all(found[v - (1 << 64) if v >> 63 else v] == want[i] for i, v in fps.items())


def test_keep_one(spark):
    rows = [*near_corpus(), (0, near_corpus()[0][1]), (None, near_corpus()[0][1]), (None, "a lonely text of its own here")]
    docs = documents(spark, rows, "_uid _fp c1 _pick")
    kept = simhash.keep_one(docs)
    want = set(link_components({d: fingerprint(t) for d, t in rows if d is not None}).values())
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, want), "None"])
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


LINES = ["alpha beta gamma delta", "one two three four five six seven", "short", "x", "", "  ", "the quick brown fox jumps over it",
         "tiny line", "another line with some words", "of"]


@pytest.mark.parametrize("seed,min_chars", [(1, 30), (2, 30), (3, 12), (4, 60)])
def test_line_dedup_equals_brute_force(spark, seed, min_chars):
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        lines = [rng.choice(LINES) if rng.random() < 0.7 else f"only here {i} {j} and nowhere else" for j in range(rng.randint(0, 14))]
        rows.append((i, "\n".join(lines)))
    block = "\n".join(rng.choice(LINES) + str(k) for k in range(25))
    rows += [(50, block), (51, "head\n" + block + "\ntail"), (52, block), (53, None), (54, "")]
    docs = documents(spark, rows, "len a b r0 _gone _gone_id _lines c0")
    out = line_dedup.dedup_lines(docs, min_chars=min_chars)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == dedup_lines(rows, min_chars)


def test_line_dedup_odd_rows(spark):
    same = "a line that is long enough to count as one\nsecond line that is long enough too"
    rows = [(1, same), (1, same), (None, same), (2, "   \n" + same), (3, same.split("\n")[0] + "\n" + "z " * 50_000)]
    out = line_dedup.dedup_lines(documents(spark, rows), count="gone").collect()
    by = sorted((str(r.doc_id), r.text[:12], r.gone) for r in out)
    # the null id comes first, so its copy stays; repeated rows are one document
    assert by == [("1", "", 2), ("1", "", 2), ("2", "", 2), ("3", "z z z z z z ", 1), ("None", "a line that ", 0)]
    assert line_dedup.dedup_lines(documents(spark, rows).limit(0)).count() == 0


ITEMS = [
    (1, "A train leaves Berlin at 60 km per hour and reaches Hamburg after 5 hours; how far apart are Berlin and Hamburg"),
    (2, "What is the capital city of that small country near the northern sea coast"),
    (3, "too few"),
    (4, None),
    (None, "no id for this question about nothing in particular at all here"),
    (5, "short but long enough question"),
]


def leaks(spark, rows, **options):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    return decontaminate.find_leaks(documents(spark, rows, "h width item_id j"), bench, **options)


def test_leaks_exact_reparameterised_and_inconsistent(spark):
    q = ITEMS[0][1]
    changed = q.replace("Berlin", "Lisbon").replace("Hamburg", "Porto").replace("60", "75,5").replace("5 hours", "3 days")
    broken = q.replace("near", "near").replace("after 5", "after 9").replace("are Berlin", "are Munich")
    rows = [
        (1, "Some words before. " + q + ". And after."),
        (2, "they said: in short A train " + changed.split(" train ", 1)[1]),
        (3, "so " + broken),
        (4, "What IS the capital city of that small country near the northern sea coast"),
        (5, "a clean text about a train that leaves and a city near the sea, 60 km away"),
        (6, None),
        (7, ""),
        (8, "filler " * 30_000 + ITEMS[1][1]),
        (9, "this is a short but long enough question indeed"),
        (1, "Some words before. " + q + ". And after."),
        (None, "x " + ITEMS[1][1].lower()),
    ]
    for option in ({}, {"broadcast_windows": 0}):
        got = {(r.doc_id, r.item_id): r.reparameterised for r in leaks(spark, rows, **option).collect()}
        assert got == {(1, 1): False, (2, 1): True, (4, 2): False, (8, 2): False, (9, 5): False, (None, 2): False}
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows, "h width item_id j _leak_id _leak_hash c4")
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7]
    assert decontaminate.drop_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_leaks(docs, bench.limit(0)).count() == len(rows)


def test_leak_slots_are_those_of_matched_windows(spark):
    """What follows an excerpt, or an inserted word, takes no part in the slots."""
    q, words = ITEMS[0][1], ITEMS[0][1].split()
    rows = [
        (1, "so " + " ".join(words[:16]) + " we met Smith before 9 hours of Berlin Paris to Munich at 60 or 7 of Rome and Oslo"),
        (2, "so " + q.replace("how far apart are", "how far apart really are")),
        (3, "so " + q.replace("are Berlin", "are Munich")),
    ]
    got = {(r.doc_id, r.item_id): r.reparameterised for r in leaks(spark, rows).collect()}
    assert got == {(1, 1): False, (2, 1): False}
    names = "the letter of Anna Smith went by ship from there to the house of Anna Smith in the old town"
    bench = spark.createDataFrame([(1, names)], "item_id long, text string")
    docs = documents(spark, [(1, names.replace("went by", "then went by"))])
    assert [r.reparameterised for r in decontaminate.find_leaks(docs, bench).collect()] == [False]


def test_leaks_over_diagonals_and_excerpts_of_long_items(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    bench = spark.createDataFrame([(1, " ".join(words[:60])), (2, " ".join(words[100:400]))], "item_id long, text string")
    spread = [x for i, w in enumerate(words[:60]) for x in ((w, "inserted") if i % 11 == 10 else (w,))]
    gone = [w for i, w in enumerate(words[:60]) if i % 11 != 10]
    far = [x for i, w in enumerate(words[:60]) for x in ((w, *["inserted"] * 40) if i % 11 == 10 else (w,))]
    rows = [
        (1, "a b c " + " ".join(spread)),
        (2, " ".join(gone)),
        (3, "a b c " + " ".join(words[200:260]) + " d e f"),
        (4, "a b c " + " ".join(words[200:220]) + " d e f"),  # 13 windows
        (5, " ".join(far)),  # parts of 4 windows, far from each other
    ]
    got = {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.find_leaks(documents(spark, rows), bench).collect()}
    assert got == {(1, 1): 20, (2, 1): 15, (3, 2): 53}


def test_template_forms_have_equal_places(spark):
    texts = ["Pay 1,000.50 dollars to Anna Smith, not 3 km2 or 0pt.", "X 5kg 7 hours 12:30 Über Öl geht es", "", "!!", "10p 0 0n 007", "McDonald's AnnaLee"]
    df = decontaminate.with_forms(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    for r in df.withColumn("s", decontaminate.slot_words(df.t)).collect():
        named, slots = r._n.split(), list(r.s)
        assert len(named) == len(slots) and (r._v is None or len(r._v.split()) == len(named))
        marks = (decontaminate.NAME, decontaminate.NUMBER, decontaminate.UNIT)
        assert all(x == y or (x[0] in marks and x[0] == y[0]) for x, y in zip(named, slots))


def found(spark, items, rows):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.reparameterised for r in decontaminate.find_leaks(documents(spark, rows), bench).collect()}


def test_leaks_of_short_questions_and_other_case(spark):
    items = [
        "Maria buys 5 apples for 10 dollars",
        "Which river is the longest in Asia",
        "The old Bridge of Konitsa crosses a river near the Town of Konitsa and was built by Zisis",
        "3 4 5 6",
    ]
    rows = [
        (1, "Peter buys 7 apples for 14 dollars"),
        (2, "They wrote that Maria buys 5 apples for 10 dollars each"),
        (3, "he asked Which river is the longest in Asia, and left"),
        (4, items[2].lower()),
        (5, "x " + items[2].upper() + " y"),
        (6, "Peter sells 7 pears for 14 dollars; the longest river"),
        (7, "3 4 5 6"),
        (8, "1 2 3 4 5 7 and 6 5 4 3"),
    ]
    assert found(spark, items, rows) == {(1, 0): True, (2, 0): False, (3, 1): False, (4, 2): False, (5, 2): False, (7, 3): False}


def test_tables_of_numbers(spark):
    rng = random.Random(1)
    items = [" ".join(str(rng.randint(0, 99)) for _ in range(40)) for _ in range(60)]
    table = " ".join(str(rng.randint(0, 99)) for _ in range(100_000))
    rows = [(1, table), (2, "0 " * 50_000), (3, "see " + items[7] + " there"), (4, " ".join(items[9].split()[:20]))]
    assert found(spark, [*items, "0 " * 40], rows) == {(2, 60): False, (3, 7): False, (4, 9): False}


def test_leaks_equal_their_sql(spark, tmp_path):
    import duckdb

    from monthwise.llm import oracles

    rng = random.Random(6)
    vocab = ["alpha", "beta", "Gamma", "delta", "5", "12.5", "km", "Berlin", "Anna", "of", "the", "zeta", "eta", "Über"]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.choice([4, 6, 12, 30, 60]))) for _ in range(30)]
    docs = []
    for i in range(60):
        words = rng.choice(items).split()
        for _ in range(rng.choice([0, 0, 1, 4])):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice([[], ["new"] * rng.choice([1, 20]), words[:9]])
        swap = rng.choice([{}, {"5": "7"}, {"Anna": "Maria", "Berlin": "Rom"}])
        text = " ".join(swap.get(w, w) for w in words)
        if rng.random() < 0.2:
            text = text.replace("Berlin", "Paris", 1)
        docs.append((i, "so " * rng.randrange(40) + rng.choice([text, text.lower(), text.upper(), text + ". " + text])))
    docs += [(None, items[3]), (3, None), (4, ""), docs[0], docs[0]]
    bench = [(i % 25, t) for i, t in enumerate(items)] + [(None, items[0]), (40, None)]
    documents(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = decontaminate.op4_decontaminate(spark, str(tmp_path))
    got = sorted(map(str, (tuple(r) for r in df.collect())))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    cur = con.execute(oracles.DECONTAMINATE)
    assert [d[0] for d in cur.description] == df.columns
    assert got == sorted(map(str, cur.fetchall()))
    assert len(got) > 40 and any("True" in r for r in got)
