"""The Merkle manifest against a tree built plainly."""

import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from roadlake.llm import merkle


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def runs_up(nodes):
    """Levels of [(hash, siblings left, siblings right)] from the given nodes to one."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        levels.append([("".join(r[:i]), "".join(r[i + 1 :])) for r in runs for i in range(len(r))])
        nodes = [digest(*r) for r in runs]
    return levels, nodes[0] if nodes else None


def climb(levels, at):
    for level in levels:
        yield level[at]
        at //= 8


def plain(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        trees[x].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    built = {x: runs_up([leaf(r, r["text"]) for r in trees[x]]) for x in langs}
    top, root = runs_up([built[x][1] for x in langs])
    out = []
    for n, x in enumerate(langs):
        for i, r in enumerate(trees[x]):
            steps = [*climb(built[x][0], i), *climb(top, n)]
            text, own = r["text"], leaf(r, r["text"])
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            h = leaf(r, text)
            for left, right in steps:
                h = digest(left, h, right)
            out.append((r["doc_id"], own, built[x][1], root, digest(*(a + b for a, b in steps)), h, h == root))
    return out


def check(docs):
    rows = [r.asDict() for r in docs.collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, merkle.verify_documents(docs).collect()), key=key) == sorted(plain(rows), key=key)


def test_manifest_of_odd_rows(odd_documents, no_documents):
    docs = odd_documents.withColumn("n_chars", F.length("text").cast("long"))
    check(docs.withColumn("leaf", F.lit("clash")).withColumn("tree", F.lit(1)).withColumn("place", F.lit(2)))
    assert merkle.verify_documents(no_documents.withColumn("n_chars", F.lit(None).cast("long"))).count() == 0


def test_manifest_of_hot_and_single_languages(spark):
    """A language over four levels beside languages of one row, so many that their tree has two levels."""
    rows = [(i * 7, f"Text {i % 90}", "hot", None, None if i % 5 else i) for i in range(700)]
    rows += [(i, f"T{i}", f"l{i}é" if i else None, "s", i) for i in range(11)]
    rows += [(3, "Same", "two", "s", 4)] * 2
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5))


def test_one_row(spark):
    check(spark.createDataFrame([(1, "A", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"))
