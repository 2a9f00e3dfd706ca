"""The corpus operators against brute force, exact round trips and labelled data, on test data and odd cases."""

import random

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from rateloom.llm import leak, mix, queries, reading

# ---------------------------------------------------------------- leaked items


def edits_within(item, doc):
    """Row-at-a-time: does doc hold 20 or more consecutive item words with at most one in eight edited?"""
    for s in range(len(item) - 19):
        prev = [0] * (len(doc) + 1)
        for n in range(1, min(39, len(item) - s) + 1):
            cur = [n]
            for j in range(1, len(doc) + 1):
                cur.append(min(prev[j - 1] + (item[s + n - 1] != doc[j - 1]), prev[j] + 1, cur[-1] + 1))
            prev = cur
            if n >= 20 and 8 * min(cur) <= n:
                return True
            if min(cur) > 4:
                break
    return False


def edited(words, rnd, rate):
    out = []
    for w in words:
        x = rnd.random()
        if x < rate / 3:
            continue
        out.append("zz" if x < 2 * rate / 3 else w)
        if x > 1 - rate / 3:
            out.append("yy")
    return out


def index_of(items, folder, **kw):
    return [leak.Part(p) for p in leak.parts(items, str(folder), **kw)]


@pytest.mark.parametrize("part_bytes", [1, 20_000, leak.PART_BYTES])
def test_search_equals_brute_force(tmp_path, part_bytes):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    opening = [rnd.choice(vocab) for _ in range(9)]
    items = [(i, " ".join((opening if i % 2 else []) + [rnd.choice(vocab) for _ in range(rnd.randint(15, 60))])) for i in range(40)]
    index = index_of(items, tmp_path, part_bytes=part_bytes)
    assert (len(index) == 1) == (part_bytes == leak.PART_BYTES)
    texts = []
    for _ in range(250):
        words = [rnd.choice(vocab[:30] + ["other"]) for _ in range(rnd.randrange(30))]
        for _ in range(rnd.randrange(3)):
            it = leak.words_of(rnd.choice(items)[1])
            s = rnd.randrange(max(len(it) - 15, 1))
            words += edited(it[s : s + rnd.randint(12, 40)], rnd, rnd.choice([0, 0.08, 0.13, 0.2])) + ["gap"] * rnd.randrange(3)
        texts.append("\n# ".join(" ".join(words[k : k + 7]) for k in range(0, len(words), 7)))
    got = leak.scan(index, texts)
    hits = 0
    for text, found in zip(texts, got):
        doc = leak.words_of(text)
        want = [i for i, t in items if edits_within(leak.words_of(t), doc)]
        assert sorted(found) == want
        hits += len(want)
    assert hits > 50


@pytest.mark.parametrize("block", [2, 7, 64])
def test_wand_returns_all_above_the_threshold(tmp_path, monkeypatch, block):
    monkeypatch.setattr(leak, "POSTINGS", block)
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(200))) for i in range(200)] + [(200, "a b a b " * 20)]
    (part,) = index_of(items, tmp_path)
    hits = 0
    for _ in range(20):
        keys = np.unique(np.concatenate([rnd.sample(list(leak.shingle_keys(part.text(d))), 20) for d in rnd.sample(range(200), 3)]))
        terms = [int(t) for t in part.known(keys)]
        score = np.zeros(201)
        for t in terms:
            lo, hi = part.start[t], part.start[t + 1]
            score[part.docs[lo:hi]] += part.impacts[lo:hi]
        got = part.search(terms)
        assert got == np.flatnonzero(score >= leak.NEED).tolist()
        hits += len(got)
    assert hits >= 60


def test_a_part_comes_back_from_its_file(tmp_path):
    arrays = leak.pack([(1, [f"w{i}" for i in range(30)])])
    leak.save(f"{tmp_path}/p", [1], arrays)
    part = leak.Part(f"{tmp_path}/p")
    assert part.ids == [1] and all((getattr(part, k) == v).all() and getattr(part, k).dtype == v.dtype for k, v in arrays.items())
    leak.save(f"{tmp_path}/q", [], leak.pack([]))
    assert leak.scan([leak.Part(f"{tmp_path}/q")], ["a b c d e f"]) == [[]]
    assert (tmp_path / "p").stat().st_size < 30 * leak.WORD_BYTES + 2_000


def test_odd_documents_and_items(spark, rows):
    words = [f"word{i}" for i in range(60)]
    text = " ".join(words)
    items = spark.createDataFrame([(1, text), (2, text), (3, "too short"), (4, None), (5, ""), (None, text)], "item_id long, text string")
    docs = [
        (1, text.upper()), (2, "\\n".join(words[5:25])), (3, '// "' + '" +\r\n // "'.join(words[30:50]) + '"'), (4, " ".join(words[:17])), (5, None), (6, ""), (7, "x " * 300_000 + text), (7, "x " * 300_000 + text),
        (8, " ".join(words[:10] + ["new"] + words[10:20] + ["new"])), (9, " ".join(words[:5] + ["a", "b", "c"] + words[8:20])), (None, text), (10, "9" * 200_000),
    ]
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, item_id int, bits string")
    got = leak.find_leaks(df, items)
    assert rows(got) == [(d, i) for d in (1, 2, 3, 7, 8) for i in (1, 2)]
    assert rows(leak.find_leaks(df, items, part_bytes=1)) == rows(got)
    assert leak.find_leaks(df.limit(0), items).count() == 0 and leak.find_leaks(df, items.limit(0)).count() == 0
    assert rows(leak.leaked_items(got)) == [(1, 5), (2, 5)]


# ---------------------------------------------------------------- mixture


def test_tokens_are_those_of_the_tokenizer(spark):
    import base64

    import tiktoken

    with open(f"{mix.TOKENIZERS}/{mix.VOCABULARY}", "rb") as f:
        enc = tiktoken.Encoding("t", pat_str=mix.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    texts = ["def f(x):\n    return x's  \n\n", "", None, "ß 漢字 <|endoftext|>", "a" * 100_000]
    got = {r["i"]: r["tokens"] for r in mix.token_counts(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()}
    assert got == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert enc.decode(enc.encode_ordinary(texts[3])) == texts[3]


def test_balance_meets_every_target_it_can(spark, rows):
    rnd = random.Random(1)
    counts = [(f"{s}{i}", s, rnd.randint(1, 500)) for s, n in (("a", 3000), ("b", 900), ("c", 30), ("d", 5)) for i in range(n)] + [("x", None, 1000), ("y", "other", 7000), ("z", "a", 0)]
    df = spark.createDataFrame(counts, "doc_id string, source string, tokens long")
    goal = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 3), ("c", 0.2, 2), ("d", 0.001, 1), ("none", 0.099, 4), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    solved = mix.balance(df.select("source", "tokens"), goal)
    r = {x["source"]: x for x in solved.collect()}
    total = sum(c[2] for c in counts)
    for s, share in (("a", 0.3), ("b", 0.4), ("d", 0.001)):
        assert r[s]["feasible"] and r[s]["reached"] == pytest.approx(share * total, rel=1e-5)
    assert not r["c"]["feasible"] and not r["none"]["feasible"]
    mixed = mix.copies(df, solved, "doc_id")
    rep = {x["source"]: x for x in mix.shares(mixed, solved).collect()}
    assert rep["c"]["mixed_tokens"] == 2 * sum(c[2] for c in counts if c[1] == "c") and rep["c"]["most_copies"] == 2
    assert rep["a"]["most_copies"] <= 1 and rep["b"]["most_copies"] <= 3
    assert rep["a"]["mixed_tokens"] == pytest.approx(0.3 * total, rel=0.05) and rep["b"]["mixed_tokens"] == pytest.approx(0.4 * total, rel=0.05)
    assert mixed.where("source = 'other' or source is null").agg(F.sum("copies")).first()[0] == 0
    assert mixed.count() == len(counts)
    assert mix.balance(df.limit(0).select("source", "tokens"), goal).where("feasible and target_tokens > 0").count() == 0


def test_unreachable_sources_equal_a_plain_count(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = mix.token_counts(docs.select("source", "text"))
    per = {r["source"]: r["t"] for r in counts.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    total = sum(per.values())
    want = {r["source"] for r in spark.read.parquet(f"{DATA}/mix_targets.parquet").collect() if per.get(r["source"], 0) * r["max_repeats"] < r["target_share"] * total}
    assert {r["source"] for r in queries.p9_found(spark, DATA).collect()} == want


# ---------------------------------------------------------------- reading level

CODE = "#!/bin/sh\n# First sentence here. Second one!\nx = 1  # trailing\ndef f():\n    '''Doc string\n    goes on.'''\n/* block\n * more\n */\n-- sql note\n#include <x.h>\n"


def test_prose_of_files():
    assert " ".join(reading.prose_of(CODE, "a/b.py").split()) == "First sentence here. Second one! trailing Doc string goes on. block more sql note"
    text = "# Head\r\n\r\nPlain words are here for all.\r\n```\ncode = 1\n```\nMore words follow here then.\n"
    assert " ".join(reading.prose_of(text, "x/README.md").split()) == "# Head Plain words are here for all. More words follow here then."
    assert reading.prose_of(text, "LICENSE") == reading.prose_of(text, "a.txt")
    assert reading.prose_of("import a\nx = f(1);\nreturn x;\n# note\n", "wrong.md").strip() == "note"
    # a text under the ending of a code file, strings that look like comments, a prefixed docstring, a block behind code
    assert reading.prose_of("# Plan of it\n\nSome words are here in a row.\n\n```\nx = f(1)\n```\n\nMore of them follow there.\n", "a/b.yaml").split() == "# Plan of it Some words are here in a row. More of them follow there.".split()
    assert reading.prose_of('x = "a # b"\ny = \'http://c // d\'\nr"""Raw doc\nhere"""\nint z; /* begins\nends */ int w;\n', "a.c").split() == "Raw doc here begins ends".split()
    assert reading.prose_of('{\n  "a": 1,\n  "b c d e": 2\n}\n', "a.json") == ""
    assert reading.prose_of("", None) == "" and reading.prose_of("." * 300_000 + "x", "a.txt") == "." * 300_000 + "x"


def test_measures():
    assert reading.measure("One two three. It's well-known! e.g. ok")[:3] == (8, 4, 27)
    assert reading.measure("." * 200_000 + "x")[:2] == (1, 1) and reading.measure("") == (0, 0, 0, "")


def test_isotonic_fit_is_the_least_squares_one():
    rnd = np.random.default_rng(0)
    x, y = rnd.random(60), rnd.integers(1, 6, 60).astype(float)
    xs, ys = reading.isotonic(x, y)
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) >= 0).all()
    fit = np.interp(x, xs, ys)
    order = np.argsort(x)
    yy = y[order]
    n = len(yy)
    want = [max(min(yy[i : j + 1].mean() for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
    assert np.allclose(fit[order], want)


def test_model_is_a_distribution_and_prefers_what_it_saw(spark):
    df = spark.createDataFrame([("the cat sat on the mat the cat",)] * 30 + [("катя ката 漢字",)] * 9, "prose string")
    words = reading.vocabulary(df)
    assert {r["word"]: r["n"] for r in words.collect()}["the"] == 90
    counts = reading.count_grams(words)
    brute = {}
    for r in words.collect():
        t = f"\x02{r['word']}\x03"
        for i in range(1, len(t)):
            for k in range(1, min(reading.ORDER, i + 1) + 1):
                g = t[i - k + 1 : i + 1]
                brute[g] = brute.get(g, 0) + r["n"]
    assert counts == brute
    m = reading.Model(counts)
    signs = [g for g in counts if len(g) == 1]
    for context in ("", "\x02", "\x02t", "th", "\x02the", "q", "кат"):
        assert sum(m.chance(context, x) for x in [*signs, "§"]) == pytest.approx(1.0)
    assert m.bits("the") < m.bits("hte") < m.bits("qzjx") and m.bits("катя") < m.bits("яатк")
    pruned = reading.count_grams(words, keep=0.05)
    assert len(pruned) <= reading.ORDER / 0.05 and set(pruned) < set(counts)


def test_no_prose_of_long_words_is_below_the_floor(spark):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdeé'") for _ in range(rnd.randint(1, 12))).strip("'") or "a" for _ in range(300)]
    words = spark.createDataFrame([(w, 1 + i % 7) for i, w in enumerate(dict.fromkeys(vocab))], "word string, n long")
    shared = reading.Shared(spark, reading.Model(reading.count_grams(words)))
    for letters in (3.0, 6.5, 9.0):
        low = reading.floor_of_long_words(words, shared, letters)
        size = lambda w: len(w) - w.count("'")
        long = [w for w in vocab if size(w) >= letters]
        assert low > 0 and min(map(shared.value.bits, long)) >= low
        for _ in range(200):
            text = [rnd.choice(vocab) for _ in range(rnd.randint(1, 5))] + [rnd.choice(long) for _ in range(3)]
            if sum(map(size, text)) >= letters * len(text):
                assert sum(map(shared.value.bits, text)) / len(text) >= low


def test_levels_rise_with_difficulty_and_lose_nothing(spark):
    docs, labels = spark.read.parquet(f"{DATA[:-5]}0.01/documents.parquet"), spark.read.parquet(f"{DATA[:-5]}0.01/reading_labels.parquet")
    levels = reading.reading_levels(docs, labels)
    exact = levels.rows.where("words >= 40 and words >= 18 * sentences and letters >= 6.5 * words").select("doc_id")
    gate = levels.demanding(queries.LONG_SENTENCE, queries.LONG_WORD)
    assert exact.count() > 20 and exact.join(gate, "doc_id", "left_anti").count() == 0 and gate.count() < levels.rows.where("words > 0").count()
    assert {r["doc_id"] for r in queries.p10_found(spark, DATA[:-5] + "0.01").collect()} == {r["doc_id"] for r in exact.collect()}
    # held out: fitted on a bounded half of the labels, the others are met within a level
    half = labels.where("level is not null").orderBy("doc_id").limit(20)
    rest = labels.where("level is not null").join(half, "doc_id", "left_anti")
    off = reading.reading_levels(docs, half).rows.join(rest.withColumnRenamed("level", "want"), "doc_id").where("level is not null").agg(F.avg(F.abs(F.col("level") - F.col("want")))).first()[0]
    assert off < 1.0


def test_copies_and_noisy_labels_hide_no_demanding_document(spark, tmp_path):
    rnd = random.Random(7)
    hard = " ".join(["institutional reconciliation procedures necessitate comprehensive documentation"] * 8) + "."
    other = " ".join(["administrative considerations notwithstanding participating organisations"] * 8) + "."
    easy = lambda: ". ".join(" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 5))) for _ in range(6)) for _ in range(8)) + "."
    texts = [hard if i % 3 == 0 else other if i == 1 else easy() for i in range(150)]
    docs = spark.createDataFrame([(i, t, "a.txt") for i, t in enumerate(texts)], "doc_id long, text string, path string")
    labels = spark.createDataFrame([(i, rnd.choice((1, 5)) if i % 10 == 0 else 5 if i % 3 == 0 or i == 1 else 1) for i in range(60)], "doc_id long, level int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/reading_labels.parquet")
    want = {i for i in range(150) if i % 3 == 0 or i == 1}
    assert {r["doc_id"] for r in queries.p10_found(spark, str(tmp_path)).collect()} == want
    labels.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/reading_labels.parquet")
    assert {r["doc_id"] for r in queries.p10_found(spark, str(tmp_path)).collect()} == want


def test_odd_documents_have_no_level(spark):
    docs = spark.createDataFrame([(1, None, "a.py"), (2, "", None), (3, "x = 1", "a.py"), (4, "Plain words stand here for once.", "a.txt"), (4, "Plain words stand here for once.", "a.txt"), (5, "漢字 ß퟿", "b.md"), (6, "word " * 200_000, "c.txt"), (None, "Words.", "d.txt")], "doc_id long, text string, path string").withColumn("level", F.lit(9))
    labels = spark.createDataFrame([(4, 2), (6, 4), (1, None), (99, 1)], "doc_id long, level int")
    got = sorted(((r["doc_id"], r["words"], r["level"]) for r in reading.reading_levels(docs, labels).rows.collect()), key=repr)
    by = {}
    for d, w, lv in got:
        by.setdefault(d, []).append((w, lv))
    assert by[1] == [(0, None)] and by[2] == [(0, None)] and by[3] == [(0, None)] and len(by[4]) == 2 and by[6][0][0] == 200_000 and all(x[1] is not None for x in by[4])
    assert reading.reading_levels(docs.limit(0), labels).rows.count() == 0
    assert reading.reading_levels(docs, labels.limit(0)).rows.where("level is not null").count() == 0
