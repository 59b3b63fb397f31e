"""The pipeline stage by stage against plain versions, each on what its predecessor kept, and the
registered queries on a folder of edge-case tables."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from keelson.llm import queries
from tests.llm import brute

STAGES = dict(corpus_pipeline.STAGES)
pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages_are_in_order_and_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_runs", "near_duplicates", "benchmark_passages", "sequences"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) <= set(entry.queries())


@pytest.fixture(scope="module")
def tables(spark, edge, tmp_path_factory):
    """A folder with the edge-case documents, two of them quoting the benchmark."""
    root = str(tmp_path_factory.mktemp("sf"))
    quoted = "exam question number one asks which of the following statements about rivers is certainly true today"
    more = spark.createDataFrame([(300, f"Some words before it, then: {quoted.title()}! And a few words after it, too."),
                                  (301, " ".join(f"word{i}" for i in range(400)) + " " + quoted)], "doc_id long, text string")
    edge.unionByName(more, allowMissingColumns=True).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, quoted), (2, None), (3, "short one")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0), (20, 1, 0), (83, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", None), (2, 1, "assistant", "no")],
                          "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
    spark.createDataFrame([(1, "u", "<p>some text"), (2, None, None), (2, "u", "")], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 0.5]), (3, None), (4, [float("nan"), 1.0])], "vec_id long, embedding array<float>").write.parquet(f"{root}/embeddings.parquet")
    return root


def test_each_stage_matches_its_plain_version(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    kept = STAGES["quality_rules"](spark, docs, tables)
    assert kept.columns == columns
    want = []
    for d, t in pairs(docs):
        ws = brute.SPACED.findall(t or "")
        if len(ws) >= 20 and 100 * brute.repeat_words(ws) <= 30 * len(ws):
            want.append((d, t))
    assert set(pairs(kept)) ^ set(want) == set() and len(want) == kept.count()     # no line of these texts breaks a rule

    lines = STAGES["line_runs"](spark, kept, tables)
    assert lines.columns == columns
    assert pairs(lines) == sorted(((d, k) for d, _, _, k in brute.lines(pairs(kept))), key=repr)

    ahead = pairs(lines)
    single = STAGES["near_duplicates"](spark, lines, tables)
    assert single.columns == columns
    groups = brute.groups(ahead, 5, 80)
    keep = Counter((d, t) for (d, t), (_, _, c) in zip(ahead, groups, strict=True) if d is None or d == c)
    left = Counter(pairs(single))
    assert set(left) <= set(keep) and {d for d, _ in left} == {d for d, _ in keep}
    assert all(n == 1 for (d, _), n in left.items() if d is not None)

    clean = STAGES["benchmark_passages"](spark, single, tables)
    assert clean.columns == columns
    items = [(1, spark.read.parquet(f"{tables}/benchmark.parquet").filter("item_id = 1").first().text), (3, "short one")]
    bad = {d for d, n, hit, _ in brute.contamination(pairs(single), items) if hit and 20 * hit >= n}
    assert bad == {300} and pairs(clean) == [x for x in pairs(single) if x[0] not in bad]

    packed = STAGES["sequences"](spark, clean, tables).toPandas()
    assert packed.n_words.sum() == sum(len(brute.SPACED.findall(t or "")) for _, t in pairs(clean))
    assert packed.groupby("bin_id").n_words.sum().max() <= 2048


def test_stages_on_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).count() == 0, name


def test_queries_on_edge_tables(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        got = query(spark, tables)
        assert len(set(got.columns)) == len(got.columns)
        n = got.count()
        if name.startswith("op9"):
            assert n == 2
        elif name.startswith("op12"):
            assert n == 3
        elif name.startswith("op13"):
            assert n == 2 * 2
        elif name.startswith("op6"):
            assert n >= rows
        else:
            assert n == rows, name
