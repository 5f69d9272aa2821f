"""Operators on documents against the contracts written plainly, and on odd rows."""

import hashlib
from collections import Counter, defaultdict
from random import Random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import (
    contamination,
    mixing,
    neardup,
    outliers,
    perplexity,
    sharding,
    suffixdup,
    toxicity,
)

SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


# --- near-duplicates ---------------------------------------------------------------


def test_near_duplicates_equal_all_pairs(spark):
    docs = documents(spark)
    sets = {r.doc_id: brute.shingles(r.text) for r in docs.collect()}
    expected = brute.components(sets)
    for r in neardup.near_duplicates(docs).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), expected[r.doc_id], r.doc_id == expected[r.doc_id])


def test_large_group_of_edited_copies(spark, monkeypatch):
    """More copies than a node compares, some too far apart to link: nodes branch and are cut."""
    monkeypatch.setattr(neardup, "SMALL", 24)
    monkeypatch.setattr(neardup, "DEPTH", 2)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(120):
        words = list(base)
        for at in rng.choice(150, size=i % 6, replace=False):
            words[at] = f"x{i}-{at}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute.components({i: brute.shingles(t) for i, t in texts.items()})
    assert len(set(expected.values())) > 3
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()} == expected


def test_near_duplicates_of_odd_rows(odd_documents, no_documents):
    found = rows_of(neardup.near_duplicates(odd_documents))
    assert len(found) == odd_documents.count()
    of = defaultdict(set)
    for r in found:
        of[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert of[13] == {(0, 13)} and of[0] == {(0, 0)} and of[2] == {(1, 2)} and of[11] == of[12] and {c for _, c in of[21]} == {10}
    assert {c for _, c in of[None]} == {None}
    kept = neardup.keep_one_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert Counter(r.doc_id for r in kept.collect())[12] == 0 and kept.where("doc_id = 10").count() == 1
    assert neardup.near_duplicates(no_documents).count() == 0


# --- repeated strings --------------------------------------------------------------


def check_repeats(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute.repeats(texts.items())
    for r in suffixdup.repeat_report(docs).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], r.doc_id


def test_repeats_of_the_small_table(spark):
    check_repeats(spark, {r.doc_id: r.text for r in documents(spark).collect()})


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_at_random_places(spark, seed):
    rnd = Random(seed)
    pool = "".join(rnd.choice("ab é") for _ in range(3000))
    texts = {}
    for i in range(25):
        parts = [pool[(a := rnd.randrange(2700)) : a + rnd.randrange(300)] for _ in range(4)]
        texts[i] = ("=" * rnd.randrange(400)).join(parts)
    check_repeats(spark, texts)


def test_repeats_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffixdup, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(suffixdup, "BUCKET_SUFFIXES", 500)
    check_repeats(spark, {r.doc_id: r.text for r in documents(spark).collect()})


def test_repeats_of_odd_rows(odd_documents, no_documents):
    cut = suffixdup.remove_repeats(odd_documents)
    assert cut.columns == [*odd_documents.columns, "cut"] and cut.count() == odd_documents.count()
    kept = defaultdict(list)
    for r in cut.collect():
        kept[r.doc_id].append((bytes(r.cut.kept), r.text))
    assert kept[13] == [(b"", None)] and kept[11][0][0] == b"" and kept[10][0][0].decode() == kept[10][0][1]
    assert len(kept[12]) == 2 and all(k.decode() == t for k, t in kept[12] + kept[None])
    assert kept[14][0][0] == b"x"  # every later byte lies in a run that starts one byte earlier as well
    assert suffixdup.repeat_report(no_documents).count() == 0


# --- contamination -----------------------------------------------------------------


def test_contamination_equals_plain_search(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    plain = [(r.item_id, r.text) for r in items.collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = 0
    for r in contamination.contamination_report(docs, items).collect():
        n, hit, found = brute.contamination(texts[r.doc_id], plain)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), digest)
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        seen += r.contaminated
    assert seen > 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_short_items_in_small_blocks_and_shards(spark, seed):
    rnd = Random(seed)

    def words(n):
        return " ".join(rnd.choice("ab c dé the".split()) for _ in range(n))

    items = [(i, words(rnd.randrange(16))) for i in range(8)] + [(3, None), (9, "THE ab")]
    texts = [(i, words(rnd.randrange(80))) for i in range(20)] + [(30, None), (31, "")]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = contamination.with_findings(docs, bench, "found", shard_bytes=200, block_bytes=60)
    for r in found.collect():
        n, hit, ids = brute.contamination(r.text, items)
        assert (r.found.n_words, sum(s.end - s.start for s in r.found.words), sorted(set(r.found["items"]))) == (n, hit, sorted(set(ids)))


def test_contamination_of_odd_rows(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "one"), (None, None), (2, "")], "item_id long, text string")
    clean = contamination.clean_documents(odd_documents, bench)
    assert clean.columns == odd_documents.columns and clean.count() == odd_documents.count() - 1
    assert contamination.contamination_report(odd_documents, bench.limit(0)).where("contaminated").count() == 0
    assert contamination.contamination_report(no_documents, bench).count() == 0


# --- sharding ----------------------------------------------------------------------


def check_shards(frame, n, shards):
    rows = frame.collect()
    assert len(rows) == n
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    return {s: sum(r.size for r in part) for s, part in by.items()}


def test_shards_are_near_equal(spark):
    docs = documents(spark)
    largest = docs.agg(F.max(F.octet_length("text"))).first()[0]
    sizes = check_shards(sharding.shard_report(docs), docs.count(), 24)
    share = sum(sizes.values()) / 24
    assert max(abs(s - share) for s in sizes.values()) <= largest + 8


def test_hot_text_is_split_and_others_stay_together(spark):
    rows = [(i, "same text " * 20) for i in range(400)] + [(1000 + i, f"text {i // 2} " * 20) for i in range(800)]
    found = sharding.shard_report(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = check_shards(found, 1200, 24)
    assert max(sizes.values()) < 1.05 * min(sizes.values())
    apart = found.groupBy("text_crc32").agg(F.countDistinct("shard").alias("k"), F.count(F.lit(1)).alias("n"))
    assert apart.where("n = 2 and k > 1").count() <= 23


def test_shards_of_odd_rows(odd_documents, no_documents):
    placed = sharding.shard_documents(odd_documents, shards=5, prefix="out_")
    assert placed.columns == [*odd_documents.columns, "out_size", "out_shard", "out_slot"]
    check_shards(placed.selectExpr("out_size as size", "out_shard as shard", "out_slot as slot"), odd_documents.count(), 5)
    assert sharding.shard_report(no_documents).count() == 0


# --- quality -----------------------------------------------------------------------


def test_statistics_equal_plain_counts(spark, odd_documents):
    docs = documents(spark).select("doc_id", "text").union(odd_documents.select("doc_id", "text"))
    for r in docs.select("text", outliers.text_statistics("text").alias("s")).collect():
        assert tuple(r.s) == brute.statistics(r.text)


def test_outliers_are_rejected_and_prose_is_kept(spark):
    report = outliers.outlier_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labelled = report.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed")
    assert labelled.where("quality = 1 and not kept").count() == 0
    assert labelled.where("quality = 0 and kept").count() == 0


def test_covariance_determinant_ignores_a_third_of_junk(spark):
    rng = np.random.default_rng(1)
    good = rng.normal([5, 1, 0.2, 0.1, 0.1], 0.05, (400, 5))
    bad = rng.normal([7, 3, 4, 0.9, 3], 0.01, (90, 5))
    rows = [("en", "a", x.tolist()) for x in np.concatenate([good, bad])]
    model = outliers.fit(spark.createDataFrame(rows, "lang string, source string, x array<double>")).where("level = 0").first()
    assert np.allclose(model.mu, good.mean(axis=0), atol=0.05)


def test_repetition_or_lines_alone_are_outliers_of_a_tight_group(spark):
    rng = np.random.default_rng(4)

    def words(n):
        return [f"w{v:05d}" for v in rng.integers(0, 100_000, n)]

    rows = [(i, " ".join(words(200)), "en", "a") for i in range(400)]
    half, lines = words(45), words(300)
    rows += [(1000, " ".join(half + half + words(110)), "en", "a")]  # 45 % of the words repeated
    rows += [(1001, "\n".join([" ".join(lines[:k + 7]) for k in range(0, 2)] + ["ab"] * 41 + [" ".join(words(200))]), "en", "a")]
    report = outliers.outlier_report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    found = {r.doc_id: r for r in report.collect()}
    assert not found[1000].base_failed and not found[1001].base_failed
    assert found[1000].n_repeat_words == 90 and found[1001].n_dup_lines == 40
    assert not found[1000].kept and not found[1001].kept
    assert sum(not r.kept for i, r in found.items() if i < 1000) == 0


def test_quality_of_odd_rows(odd_documents, no_documents):
    assert outliers.outlier_report(odd_documents).count() == odd_documents.count()
    kept = outliers.filter_documents(odd_documents)
    assert kept.columns == odd_documents.columns and kept.where("doc_id in (0, 1, 2, 3, 13)").count() == 0
    assert outliers.outlier_report(no_documents).count() == 0 and outliers.filter_documents(no_documents).count() == 0


# --- mixing ------------------------------------------------------------------------


def test_seats_go_to_the_highest_quotients(spark):
    rng = np.random.default_rng(3)
    for seats in (0, 1, 7, 100, 991):
        shares = {f"p{i:02d}": float(v) for i, v in enumerate(rng.integers(0, 50, 17) ** 3)}
        picks = sorted(((-v / (2 * k - 1), p, k) for p, v in shares.items() for k in range(1, seats + 2) if v > 0))[:seats]
        expected = Counter(p for _, p, _ in picks)
        frame = spark.createDataFrame([(p, v, seats) for p, v in shares.items()], "p string, v double, seats long")
        found = mixing.apportion(frame, "seats", "v", [], [F.col("p")], "got")
        assert {r.p: r.got for r in found.collect() if r.got} == dict(expected)


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix_report(docs).join(docs.select("doc_id", "source"), "doc_id")
    assert mixed.where("taken > 3 * size or taken < 0").count() == 0
    for r in mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(r.n - r.t) < 1


def test_small_source_beside_a_huge_one_is_taken_whole(spark):
    """Sizes only: 300 documents of 20 words and 40 of one word beside 80 million others."""
    rows = [(i, "small", 20) for i in range(300)] + [(1000 + i, "tiny", 1) for i in range(40)]
    rows += [(2000 + i, "zhuge", 40_000) for i in range(2000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("place", F.md5(F.col("doc_id").cast("string")))
    mixed = mixing.mix(sized)
    by_source = {r.source: r for r in mixed.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()}
    assert (by_source["small"].n, by_source["small"].t, by_source["tiny"].n) == (18_000, 18_000, 120)
    assert mixed.where("source <> 'zhuge' AND taken <> 3 * size").isEmpty()
    assert abs(by_source["zhuge"].n - by_source["zhuge"].t) < 1 and mixed.where("taken > 3 * size").isEmpty()


def test_mix_of_odd_rows(odd_documents, no_documents):
    mixed = mixing.mix_report(odd_documents)
    assert mixed.count() == odd_documents.count() and mixed.where("size = 0 and taken > 0 or taken > 3 * size").count() == 0
    assert mixing.mix_documents(odd_documents).columns == odd_documents.columns
    assert mixing.mix_report(no_documents).count() == 0 and mixing.mix_documents(no_documents).count() == 0


# --- toxicity ----------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    lexicon = ["idiot", "scum", "loser", "looser", "lowei*", "été"]
    automaton = toxicity.Automaton(lexicon)
    rng = np.random.default_rng(2)
    words = {"idiot", "loser", "loweichen", "lowe", "scum", "scam", "été", "", "idio", "xidiot", "loseer", "lossr"}
    letters = list("idotlserwuméx")
    for w in ("idiot", "looser", "loser", "lowei", "scum"):
        for _ in range(60):
            v = list(w)
            for _ in range(rng.integers(0, 3)):
                at = int(rng.integers(0, len(v) + 1))
                v[at : at + int(rng.integers(0, 2))] = [str(rng.choice(letters))] * int(rng.integers(0, 2))
            words.add("".join(v))
    words.discard("")
    ordered = sorted(words)
    points = np.array([ord(c) for w in ordered for c in w], np.uint32)
    lengths = np.array([len(w) for w in ordered])
    verdict = automaton.read_words(points, np.cumsum(lengths) - lengths, lengths)
    for w, v in zip(ordered, verdict.tolist(), strict=True):
        exact = w in lexicon or w.startswith("lowei")
        near = any(edits(w, t) <= 1 for t in lexicon if not t.endswith("*") and len(t) >= toxicity.FUZZY)
        assert v == (2 if exact else 1 if near else 0), w


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    scored = toxicity.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    found = scored.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    right = np.mean([r.toxic == r.predicted for r in found])
    caught = np.mean([r.predicted for r in found if r.toxic == 1])
    assert right > 0.98 and caught > 0.9


def test_toxicity_of_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(10, 1), (11, 0), (13, None), (None, 1), (12, 0)], "doc_id long, toxic int")
    scored = toxicity.score_documents(odd_documents, labels)
    assert scored.count() == odd_documents.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    unknown = scored.where("held_out is null").collect()
    assert [r.doc_id for r in unknown] == [None] and unknown[0].score is not None and unknown[0].predicted in (0, 1)
    assert toxicity.score_documents(odd_documents, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.score_documents(no_documents, labels).count() == 0


def test_quotation_counts_less_than_abuse():
    import pyarrow as pa

    automaton = toxicity.Automaton(["idiot"])
    plain, quoted = toxicity._features_of(pa.array(["you are an idiot and more", 'they wrote "idiot" in the report']), automaton)
    assert plain[0] > 0 and plain[2] == 0 and quoted[0] == 0 and quoted[2] > 0


def test_quoted_and_rare_terms_are_learned(spark):
    """A term that clean documents quote often, and one in 0.5 % of the toxic ones."""
    rows = [(f"plain words number {i} you are a total grobnik today", 1) for i in range(300)]
    rows += [(f"plain words number {i} what a vile zarfling he is", 1) for i in range(5)]
    rows += [(f"plain words number {i} and nothing much to say here", 1) for i in range(695)]
    rows += [(f'plain words number {i} they wrote "grobnik" in the report of the day', 0) for i in range(400)]
    rows += [(f"plain words number {i} about a quiet day and nothing much to say", 0) for i in range(3600)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    for word in ("grobnik", "zarfling"):
        assert any(t == word or (t.endswith("*") and word.startswith(t[:-1])) for t in lexicon), word
    assert not {"plain", "words", "number", "nothing", "report"} & set(lexicon)


def test_misspellings_of_inflected_words_and_with_symbols(spark):
    import pyarrow as pa

    rows = [(f"number {i} you are a {w} today and more", 1) for i in range(100) for w in ("moron", "morons")]
    rows += [(f"number {i} you are an idiot today and more", 1) for i in range(100)]
    rows += [(f"number {i} you are a calm one on an odd day, today and more", 0) for i in range(2000)]
    automaton = toxicity.Automaton(toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int")))
    caught = ["a mron here", "two moeron s", "a m0ron here", "an id!ot", "xm0rons", "an id-iot", "m0ron"]
    other = ["a m0r0n here", "an id! ot", 'an id"ot', "a day.today", "", "id", "id!"]
    found = toxicity._features_of(pa.array(caught + other), automaton)
    assert (found[:, 0] == 0).all() and (found[:, 1] > 0).tolist() == [c != "xm0rons" for c in caught] + [False] * len(other)
    # Hits by themselves stay so, and the marks around a joined word count as for any other.
    both = toxicity._features_of(pa.array(["idiot,moron", "so idiot's", 'they wrote "id!ot" in the report']), automaton)
    assert both[0, 0] == pytest.approx(np.log(3)) and both[1, 0] > 0 and (both[:2, 1] == 0).all()
    assert both[2, 1] == 0 and both[2, 2] > 0


# --- perplexity --------------------------------------------------------------------


def kneser_ney(texts, order=perplexity.ORDER):
    """Interpolated modified Kneser-Ney over bytes, by dictionaries."""
    counts = {order: Counter()}
    for t in texts:
        data = bytes(order - 1) + t.encode()
        counts[order].update(data[i : i + order] for i in range(len(data) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, contexts = {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
        cuts[k] = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.5 * (i + 1), 0.05), i + 0.95) for i in range(3)]
        contexts[k] = defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            contexts[k][g[:-1]][0] += v
            contexts[k][g[:-1]][1] += cuts[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        if g[:-1] not in contexts[k]:
            return p(g[1:])
        total, left = contexts[k][g[:-1]]
        c = counts[k].get(g, 0)
        return (c - cuts[k][min(c, 3) - 1] if c else 0) / total + left / total * p(g[1:])

    return p


def test_log_probabilities_equal_plain_model(spark):
    docs = documents(spark).limit(40).union(spark.createDataFrame([(-1, "zzz ###", None, None, None), (-2, None, "x", None, None), (-3, "", None, None, None)], documents(spark).schema))
    docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(3).persist()
    trusted = docs.where("doc_id >= 0 and doc_id % 2 = 0")
    p = kneser_ney([r.text or "" for r in trusted.collect()])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in perplexity.log_probabilities(docs, perplexity.train(trusted)).collect():
        data = bytes(perplexity.ORDER - 1) + texts[r.doc_id].encode()
        expected = sum(np.log(p(data[i : i + perplexity.ORDER])) for i in range(len(data) - perplexity.ORDER + 1))
        assert r.n_bytes == len(texts[r.doc_id].encode()) and r.logp == pytest.approx(expected, rel=1e-4)


def test_perplexity_keeps_prose(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = perplexity.judge_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id")
    assert judged.where("quality = 1 and not kept").count() <= 2
    assert judged.where("quality = 0 and kept").count() < 0.2 * judged.where("quality = 0").count()


def test_perplexity_of_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(10, 1), (14, 0), (None, 1), (13, 1)], "doc_id long, quality int")
    found = perplexity.judge_documents(odd_documents, labels)
    assert found.count() == odd_documents.count()
    assert found.where("doc_id in (0, 13) and (kept or perplexity is not null)").count() == 0
    assert perplexity.judge_documents(odd_documents, labels.limit(0)).where("n_bytes > 0 and not kept").count() == 0
    assert perplexity.judge_documents(no_documents, labels).count() == 0
