"""Phrases, the positional index and hard negatives against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import negatives, phrases, postings, words

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
DOCS = "doc_id long, text string, lang string, phrase string, f long, row long, n long"


def test_words_are_those_of_a_plain_pattern():
    import pyarrow as pa

    rng = random.Random(3)
    texts = ["", "É. a", "..", "x", *("".join(rng.choice("abZ é日-9 .\n") for _ in range(rng.randint(0, 300))) for _ in range(200))]
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for size in (1 << 20, 64, 7):
        got = defaultdict(list)
        for lo, _, w in words.cut_words(pa.array(["dropped", *texts]).slice(1), postings.WORD, np.zeros(256, bool), 4, size):
            values = w.values.to_pylist()
            for row, place, code, fresh in zip(w.row + lo, w.place, w.codes, w.fresh):
                if fresh:
                    got[int(row)].append((int(place), values[code]))
        for i, t in enumerate(texts):
            assert got[i] == list(enumerate(pattern.findall(t.translate(LOW)))), (size, t)


def mined(rows, most, least):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q[i : i + k] for q, a in found.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if q[i : i + k] in found and 100 * a >= 80 * found[q[i : i + k]]}
        rows = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if p not in inside:
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("most,size", [(5, 1 << 20), (40, 3000)])
def test_collocations(spark, most, size):
    rng = random.Random(most)
    vocabulary = ["the", "The", "of", "x-y", "é", "日本", *(f"w{i}" for i in range(25))]
    fixed = [["new", "york"], ["on", "the", "other", "hand"], ["in", "spite", "of"], ["a", "b", "a", "b", "a"]]
    rows = [(None, None, "en"), (1, "", None), (2, "...\n ,", "en"), (3, "É " * 50, None)]
    for i in range(300):
        out = []
        for _ in range(rng.randint(1, 60)):
            out += rng.choice(fixed) if rng.random() < 0.2 else [vocabulary[min(int(rng.expovariate(0.2)), 30)]]
            out[-1] += rng.choice(["", "", "", "", ",", ".", "\n", "\t"])
        rows.append((10 + i % 250, " ".join(out), rng.choice(["en", "en", "de", None])))
    rows += [rows[10]] * 40 + [(999, " ".join(rng.choice(vocabulary) for _ in range(20_000)), "fr")]
    docs = spark.createDataFrame([(*r, "p", 1, 2, 3) for r in rows], DOCS).repartition(3)
    got = phrases.collocations(docs, most, 6, size).drop("n_words").collect()
    assert sorted(map(tuple, got)) == mined([(r[2], r[1]) for r in rows], most, 6)
    assert phrases.collocations(docs.where("false"), most, 6).count() == 0


def test_phrases_are_summed_by_bucket_not_in_tables_of_a_task(spark):
    rng = random.Random(11)
    rows = [(lang, " ".join(rng.choice(["a", "b", "É", "日本", "x-y"]) for _ in range(300))) for lang in ["en", "de", "en", "und"] for _ in range(5)] + [("en", ""), ("fr", "a, a")]
    parts = phrases._cut_up(spark.createDataFrame(rows, "lang string, text string").repartition(3), 1000)
    word = parts.select("lang", F.explode("words").alias("phrase")).distinct()
    f = defaultdict(Counter)
    for lang, text in rows:
        w = text.translate(LOW).split(" ")
        f[lang].update(" ".join(w[i : i + 3]) for i in range(len(w) - 2))
    for buckets, least in ((1, 1), (7, 12), (100_000, 12)):
        got = phrases._counts(parts, 3, phrases.Sieve(word), {}, buckets, least)
        assert sorted(map(tuple, got.collect())) == sorted((lang, p, a) for lang, c in f.items() for p, a in c.items() if a >= least and "," not in p)
        assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_sieve_takes_at_most_four_bytes_a_phrase(spark):
    rows = spark.range(100_000).select(F.lit("en").alias("lang"), F.concat(F.lit("w"), F.col("id"), F.lit(" x")).alias("phrase"))
    sieve, lang = phrases.Sieve(rows), phrases._hashes(["en"])
    hashes = lambda ids, last: phrases._chained([phrases._chained([lang, phrases._hashes([f"w{i}" for i in ids])]), phrases._chained([lang, phrases._hashes([last])])])
    assert sieve.bits.nbytes <= 400_000
    assert sieve.passes(hashes(range(100_000), "x")).all()
    assert sieve.passes(hashes(range(100_000), "y")).mean() < 0.01
    full = phrases.Sieve(rows, 14)  # as a set beyond the most bits: more pass, none is lost
    assert full.log == 14 and full.passes(hashes(range(100_000), "x")).all()


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 9_000_000_000_000_000, 9_000_000_000_000_001, 9_100_000_000_000_000
    grams = spark.createDataFrame([("en", "a b", a)], "lang string, phrase string, f long")
    known = spark.createDataFrame([("en", "a", left), ("en", "b", right)], "lang string, phrase string, f long")
    r = phrases._scored(grams, known).first()
    assert (r["score"], r["bound"]) == (2_000_000 * a // (left + right), 2_000_000 * a // (left + a))


def contaminated(docs, items, length):
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))
    runs = defaultdict(set)
    for i, t in items:
        w = find(t)
        for k in range(max(1, len(w) - length + 1) if w else 0):
            runs[tuple(w[k : k + length])].add(i)
    out = []
    for d, t in docs:
        w, hit, ids = find(t), set(), set()
        for n in {len(r) for r in runs}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in runs:
                    hit |= set(range(k, k + n))
                    ids |= runs[tuple(w[k : k + n])]
        out.append((str(d), len(w), len(hit), tuple(sorted(i for i in ids if i is not None))))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = ["a", "B", "ç", "d1", *(f"w{i}" for i in range(12))]
    run = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, run(rng.randint(1, 14))) for i in range(40)] + [(40, None), (41, "..."), (None, run(6)), (3, run(7)), (42, "never-seen " * 6), (43, "a a a a a a a a")]
    docs = [(None, None), (1, ""), (2, "a"), (2, "a " * 500)]
    for i in range(120):
        docs.append((i, ", ".join(rng.choice(items)[1] or "-" if rng.random() < 0.3 else run(rng.randint(1, 30)) for _ in range(rng.randint(1, 8)))))
    return docs + [docs[20], docs[20], (500, run(6000))], items


@pytest.mark.parametrize("size,block", [(1 << 20, 20_000), (500, 7)])
def test_contamination(spark, texts, size, block):
    docs, items = texts
    table = spark.createDataFrame([(*d, "en", "p", 1, 2, 3) for d in docs], DOCS).repartition(3)
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, block string")
    got = postings.contamination(table, bench, 5, size=size).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(sorted(r["item_ids"]))) for r in got) == contaminated(docs, items, 5)
    index = postings.build(table, 4, size)
    again = postings.search(index, postings.windows(bench, 5), phrases_a_block=block, few_terms=block)
    assert again.count() == sum(r["contaminated"] for r in got)
    assert {c["n_hit"] for c in postings.contamination(table, bench.where("false"), 5).collect()} == {0}
    assert postings.contamination(table.where("false"), bench, 5).count() == 0


def test_proximity(spark, texts):
    docs, items = texts[0][:60], [(i, t) for i, t in texts[1] if t and i is not None]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    length, slack = 4, 2
    index = postings.build(table, length + slack)
    rows = {r["row"]: r["doc_id"] for r in index.rows.collect()}
    got = {(rows[r["row"]], i) for r in postings.search(index, postings.windows(bench, length), slack).collect() for i in r["item_ids"]}
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))
    want = set()
    for (d, t), (i, s) in product(docs, items):
        w, x = find(t), find(s)
        for k in range(max(1, len(x) - length + 1) if x else 0):
            terms, reach = set(x[k : k + length]), len(x[k : k + length]) + slack
            if any(terms <= set(w[a : a + reach]) for a in range(len(w))):
                want.add((d, i))
    assert got == want


def test_an_index_answers_any_phrase(spark):
    docs = spark.createDataFrame([(1, "To be, or not to be"), (2, "not to be or to be not"), (3, None)], "doc_id long, text string")
    index = postings.build(docs)
    assert {r["term"]: r["n"] for r in index.postings.groupBy("term").agg(F.sum("n").alias("n")).collect()} == {"to": 4, "be": 4, "or": 2, "not": 3}
    ask = spark.createDataFrame([(7, ["to", "be"]), (8, ["or", "not"]), (9, ["nowhere", "to"])], "item_id long, terms array<string>")
    got = {r["doc_id"]: (sorted(r["item_ids"]), [tuple(s) for s in r["spans"]]) for r in postings.search(index, ask).join(index.rows, "row").collect()}
    assert got == {1: ([7, 8], [(0, 6)]), 2: ([7], [(1, 3), (4, 6)])}


def hard(rows, every, positives, negatives_, low, high, scale):
    good = []
    for uid, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((uid, i, label, [int(np.floor(scale * float(x))) for x in v]))
    out = []
    for uid, i, label, v in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, u, k == label) for u, j, k, w in good if u != uid)
        for s, j, _, _ in [r for r in scored if r[3]][:positives]:
            found = [r for r in scored if not r[3] and 100 * -r[0] >= low * -s and 100 * -r[0] <= high * -s][:negatives_]
            out += [(i, j, n, r[1], -s, -r[0]) for n, r in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [8.0, 2e8])
def test_hard_negatives(spark, scale):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-6, 7, 6) / 4], int(rng.integers(0, 3))) for i in rng.permutation(400)]
    rows += [rows[0], (rows[1][0], rows[5][1], rows[1][2]), (20, rows[3][1], 0), (20, rows[3][1], 0), (40, [1.0] * 3, 1), (60, [0.0] * 6, 2), (80, [], 1)]
    rows += [(None, [1.0] * 6, 1), (100, None, 1), (120, [None, *[1.0] * 5], 1), (140, [float("nan")] * 6, 1), (160, [1.0] * 6, None), (-20, [1.5] * 6, 0)]
    rows += [(1000 + i, [1.25] * 6, i % 2) for i in range(60)]
    schema = "vec_id long, embedding array<float>, label int, score string, anchor string"
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(4)
    got = negatives.hard_negatives(table, F.col("label"), 20, 4, 6, scale=scale, rows_a_shard=90, rows_a_block=7)
    assert sorted(map(tuple, got.collect())) == hard(rows, 20, 4, 6, 30, 90, scale)
    assert negatives.hard_negatives(table.where("false"), F.col("label")).count() == 0


def test_long_texts_are_worked_on_in_windows():
    """Texts above a million characters: the same scores and fingerprints as in one piece."""
    from tidegauge.llm import quality, simhash

    rng = random.Random(2)
    words = ["the", "of", "Été", "x" * 40, "a\nb", "don't", "3.14", "日本", "same same"]
    text = " ".join(rng.choice(words) for _ in range(300_000))
    assert len(text) > 1_000_000
    model = quality.Attention()
    whole = model.forward(*quality.passages([text, "short"]))["y"]
    assert np.allclose(model.score([text, "short"]), whole, atol=1e-4)
    assert np.allclose(np.concatenate(list(quality.long_passages(text))), quality.passages([text])[0], atol=1e-6)
    for size in (1, 7, 1000, 1 << 20):
        for t in (text[: 3000 if size < 100 else None], "", "one", "a b", "A b\tc\nD", " \n ", None):
            w = (t or "").encode().lower().split()
            assert simhash.fingerprint(t, 3, size) == simhash.fingerprint(t, 3, 1 << 30)
            assert len(w) != 2 or simhash.fingerprint(t, 3, size) != 0


def test_a_shingle_outside_the_frequent_ones_is_split_too(spark):
    """A key that no list names but many texts share is cut into blocks: no group is lost, whatever the block."""
    from tidegauge.llm import near_texts

    rng = random.Random(5)
    stem = "".join(chr(97 + rng.randrange(26)) for _ in range(6))
    rows = [(i, f"{stem} one two three four " + " ".join(f"u{i}w{k}" for k in range(rng.choice([0, 1, 25])))) for i in range(160)]
    keyed = near_texts.row_keys(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"])
    few, many = ({r["doc_id"]: r["component_id"] for r in near_texts.groups(keyed, block=b).collect()} for b in (16, 4096))
    assert few == many and len(set(few.values())) > 1
