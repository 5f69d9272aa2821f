"""Chat tree, page verdicts, the SQL forms, and the pipeline."""

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from roadlake.llm import chat, linktrust, outliers
from roadlake.llm.queries import ORACLES, QUERIES
from roadlake.llm.tables import prepared, stored

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    with connect(sf_dir) as db:
        assert not differences(QUERIES[name](spark, sf_dir), db, ORACLES[name])


TURNS = "conv_id long, turn long, role string, text string, start long"
ODD_TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", r"\### x </turn>\\ y"), (1, 1, "assistant", r"\### x </turn>\\ y"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, "user", "hi"), (4, 0, None, None), (None, 0, "user", "hi"),
    (5, None, "assis:tant #", "a\nb: </turn>\n### user: c"), (6, 0, "assistant", ""), (6, 1, "assistant", "é" * 50_000),
]


def test_tree_round_trip(spark):
    turns = spark.createDataFrame([(*r, 1) for r in ODD_TURNS], TURNS)
    stream, members = chat.prefix_tree(turns)
    found = sorted((str(r.conv_id), r.role, r.text) for r in chat.read_back(stream, members).collect())
    assert found == sorted((str(c), r or "", t or "") for c, _, r, t in ODD_TURNS)
    nodes = sorted(stream.collect(), key=lambda n: n.start)
    assert sum("### user: hi</turn>" in n.text for n in nodes) == 1  # shared by four conversations
    assert all(a.end == b.start for a, b in zip(nodes, nodes[1:], strict=False)) and nodes[0].start == 0
    spans = {(n.start, n.end) for n in nodes}
    for n in nodes:
        assert n.end - n.start == len(n.text) and len(n.ancestors) == n.depth
        assert all((a.start, a.end) in spans and a.end <= n.start for a in n.ancestors)
        assert n.position == sum(a.end - a.start for a in n.ancestors)
        # Depth first: nothing but descendants of a node stands between it and its descendants.
        if n.ancestors:
            above = n.ancestors[-1]
            assert all(any(x.start == above.start for x in m.ancestors) for m in nodes if above.end <= m.start < n.start)


def test_no_conversations(spark):
    assert chat.chat_report(spark.createDataFrame([], TURNS)).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, rule string")


def link(*hosts):
    return "".join(f'<p><A class="x" HREF="{h}">t</a>' for h in hosts)


def test_rules_hosts_and_paths(spark):
    cases = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/de": ("example.net", "/de", "net/", "block"), "x://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "http://b.org/fr/a": ("b.org", "/fr/a", "org/fr/", "allow"), "http://net": ("net", "", None, "allow"),
        "http://badexample.com/de/": ("badexample.com", "/de/", None, "allow"), "nothing": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://h.io?x/y": ("h.io", "", None, "allow"), "http://ÄB.com/#/z": ("Äb.com", "/", None, "allow"),
    }
    found = linktrust.judge_pages(pages(spark, [(i, u, None, "clash") for i, u in enumerate(cases)]))
    for r in found.collect():
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]


def test_distrust_runs_against_links_and_trust_along(spark):
    rows = [
        (1, "http://farm.io/", link("http://bad.net/a", "//bad.net/b")), (2, "http://farm.io/2", link("http://bad.net/", "/here", "#x")),
        (3, "http://bad.net/", link("http://ok.io/")), (4, "http://ok.io/", link("http://c.org/fr/", "mailto:x")),
        (5, "http://c.org/fr/", link("http://friend.io/")), (6, "http://friend.io/", link("http://bad.net/", "http://ok.io/")), (6, "http://friend.io/", None),
    ]
    found = {r.host: r for r in linktrust.judge_pages(pages(spark, [(*r, None) for r in rows])).collect()}
    edges = {("farm.io", "bad.net"): 3, ("bad.net", "ok.io"): 1, ("ok.io", "c.org"): 1, ("c.org", "friend.io"): 1, ("friend.io", "bad.net"): 1, ("friend.io", "ok.io"): 1}
    hosts = {h for e in edges for h in e}

    seeds = {"trust": {h: float(h == "c.org") for h in hosts}, "distrust": {h: float(h == "bad.net") for h in hosts}}
    out = {a: sum(n for (x, _), n in edges.items() if x == a) for a, _ in edges}
    trust, distrust = dict(seeds["trust"]), dict(seeds["distrust"])
    for _ in range(linktrust.ROUNDS):
        trust = {h: seeds["trust"][h] + sum(0.85 * trust[a] * n / out[a] for (a, b), n in edges.items() if b == h) for h in hosts}
        # A walk out of a host ends at pages with a rule.
        distrust = {
            h: seeds["distrust"][h] + (h not in ("bad.net", "c.org")) * sum(0.85 * distrust[b] * n / out[a] for (a, b), n in edges.items() if a == h)
            for h in hosts
        }
    assert distrust["farm.io"] == pytest.approx(0.85) and distrust["friend.io"] == pytest.approx(0.425)
    for h, r in found.items():
        assert r.trust == pytest.approx(trust[h]) and r.distrust == pytest.approx(distrust[h])
        assert r.verdict == {"bad.net": "block", "farm.io": "block"}.get(h, "allow")
    assert linktrust.judge_pages(pages(spark, [])).count() == 0


@pytest.mark.parametrize("most", [3, 100_000])
def test_farms_are_blocked_whatever_their_size(spark, monkeypatch, most):
    """1, 5 and 1,000 hosts that link only to a blocked host, a second hop, rings; hosts with one such link among many are not."""
    monkeypatch.setattr(linktrust.spread, "__defaults__", (linktrust.ROUNDS, most))
    rows, block = [("http://a.net/", ""), ("http://b.net/", ""), ("http://c.net/", "")], set()
    for name, n in (("a", 1), ("b", 5), ("c", 1000)):
        for i in range(n):
            rows.append((f"http://farm{i}.{name}.io/", link(f"http://{name}.net/x")))
            block.add(f"farm{i}.{name}.io")
    rows += [("http://second.io/", link("http://farm1.b.io/", "http://farm2.c.io/")), ("http://ring1.io/", link("http://ring2.io/", "http://a.net/")), ("http://ring2.io/", link("http://ring1.io/", "http://a.net/"))]
    block |= {"second.io", "ring1.io", "ring2.io"}
    good = [f"http://good{i}.io/" for i in range(9)]
    rows += [(g, link("http://a.net/", *[x for x in good if x != g])) for g in good]
    found = linktrust.judge_pages(pages(spark, [(i, u, h, None) for i, (u, h) in enumerate(rows)])).collect()
    assert {r.host for r in found if r.verdict == "block" and r.rule is None} == block
    assert all(r.distrust <= 1 + 1e-9 for r in found)


def test_pipeline_stages_act(spark):
    prepared(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL).persist()
        assert after.count() > 0
        if name != "shard":
            assert after.columns == columns
        if name in ("quality_rules", "near_dedup", "decontaminate"):
            assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0
        before = after
    total = before.groupBy("shard").count().count()
    assert total > 12 and set(before.columns) == {*columns, "size", "shard", "slot"}
    dropped = {r.doc_id for r in docs.select("doc_id").subtract(outliers.filter_documents(docs).select("doc_id")).collect()}
    assert dropped and not dropped & {r.doc_id for r in before.collect()}


def test_pipeline_on_odd_rows(spark, odd_documents):
    """Nulls, ties, repeated rows, long texts and clashing names, `size`, `shard` and `out_slot` among them."""
    docs = odd_documents.withColumns({c: F.lit(7) for c in ("shard", "out_slot", "out__size")})
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(prepared(spark), docs, SMALL), f"odd-{name}")
        assert docs.columns[: len(columns)] == columns and {r.doc_id for r in docs.collect()} <= ids, name
    assert docs.columns[len(columns) :] == ["size_", "shard_", "slot"]


def test_pipeline_on_no_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
