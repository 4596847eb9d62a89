"""Registered queries on the given tables: against SQL, or whole where there is none."""

import os
import zlib
from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from corpus_cases import document_rows, documents, prose, words_of
from test_mixture import targets
from test_simhash import brute_fingerprint, brute_groups
from test_token_files import ids_of, packed
from test_winnowing import brute as brute_hits

import __spark_entry__ as contract
from tripmart.llm import quality, queries
from tripmart.llm.components import connected_components
from tripmart.sources.scratch import scratch_folder

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows),
        key=repr,
    )


def test_every_operator_is_registered_once():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    relation = duck.sql(contract.oracle_sql()[name])
    assert rows_by_name(frame.columns, frame.collect()) == rows_by_name(
        relation.columns, relation.fetchall()
    )


@pytest.mark.parametrize(
    ("name", "table"),
    [(n, "pages" if n == "op4_html_text" else "documents") for n in queries.QUERIES if n not in queries.ORACLES],
)
def test_a_row_for_each(spark, duck, name, table):
    frame = contract.queries()[name](spark, SF_DIR)
    (expected,) = duck.sql(f"select count(*) from {table}").fetchall()[0]
    assert frame.count() == expected


def test_toxicity_held_out(spark, duck):
    labels = dict(duck.sql("select doc_id, toxic from labels").fetchall())
    found = contract.queries()["op9_toxicity"](spark, SF_DIR).collect()
    held = [r for r in found if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    assert sum(r.predicted and not labels[r.doc_id] for r in held) <= 0.02 * len(held)


def test_quality_against_labels(spark, duck):
    labels = dict(duck.sql("select doc_id, quality from labels").fetchall())
    found = contract.queries()["op3_quality"](spark, SF_DIR).collect()
    judged = [r for r in found if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == (labels[r.doc_id] == 1) for r in judged) >= 0.98 * len(judged)


def test_quality_fences_differ_for_every_measure(spark):
    stats = quality.document_stats(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    bounds = quality.fences(stats.filter("lang is not null")).collect()
    for column in bounds[0].fences.asDict():
        assert len({round(r.fences[column], 6) for r in bounds}) > len(bounds) / 2


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of messy tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    toxic = [(2000 + i, prose(i, 60) + " grobble snarfzit" * 4, "en", "a", 1) for i in range(40)]
    documents(spark, document_rows() + toxic).write.parquet(f"{folder}/documents.parquet")
    labels = [(2000 + i, 1, 1) for i in range(40)] + [(100 + i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, document_rows()[4][1]), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        docs.write.parquet(f"{tables}/{name}")
        docs = spark.read.parquet(f"{tables}/{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    start, clean, distinct, decontaminated, mixed = counts
    assert start - clean >= 36
    assert distinct < clean and decontaminated < distinct
    found = corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()
    assert len(found) == mixed
    assert sum(r.n_tokens for r in found) == max(r.start + r.n_tokens for r in found)


@pytest.fixture(scope="module")
def stage_rows(spark, tables):
    """(doc_id, text, source) of the documents, and of what each stage but the last leaves."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, found[-1], tables).write.parquet(f"{tables}/by-hand-{name}")
        found.append(spark.read.parquet(f"{tables}/by-hand-{name}"))
    last = corpus_pipeline.STAGES[-1][1](spark, found[-1], tables).collect()
    return [[(r.doc_id, r.text, r.source) for r in f.collect()] for f in found], last


def test_pipeline_drops_the_toxic_alone(stage_rows):
    (start, clean, *_), _ = stage_rows
    gone = Counter(start) - Counter(clean)
    planted = Counter(r for r in start if "grobble" in (r[1] or ""))
    assert not Counter(clean) - Counter(start)
    assert gone == planted


def test_pipeline_leaves_one_of_each_near_group(stage_rows):
    (_, clean, distinct, *_), _ = stage_rows
    group = brute_groups([brute_fingerprint(text) for _, text, _ in clean])
    ids = {}
    for g, (doc_id, *_) in zip(group, clean, strict=True):
        ids.setdefault(g, []).append(doc_id)
    keepers = [min((i for i in members if i is not None), default=None) for members in ids.values()]
    assert Counter(i for i, *_ in distinct) == Counter(keepers)
    assert not Counter(distinct) - Counter(clean)


def test_pipeline_drops_the_contaminated_alone(stage_rows):
    (_, _, distinct, clean, _), _ = stage_rows
    items = [(1, document_rows()[4][1]), (2, None)]
    expected = [row for row in distinct if not brute_hits([row], items)[0][-1]]
    assert Counter(clean) == Counter(expected) and len(clean) < len(distinct)


def test_pipeline_mixes_to_the_targets(stage_rows):
    (*_, docs, mixed), _ = stage_rows
    copies, sizes, taken, largest = Counter(mixed), Counter(), Counter(), Counter()
    assert not set(mixed) - set(docs)
    for row in docs:
        size, source = len(words_of(row[1])), row[2]
        assert size == 0 or copies[row] <= 2
        sizes[source] += size
        taken[source] += size * copies[row]
        largest[source] = max(largest[source], size)
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source], source


def test_pipeline_writes_the_tokens_of_all(stage_rows):
    (*_, mixed), found = stage_rows
    expected = [(i, [*ids_of(text), 0]) for i, text, _ in mixed]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter(
        (i, len(ids), zlib.crc32(packed(ids))) for i, ids in expected
    )
    found = sorted(found, key=lambda r: r.start)
    ids = [r.doc_id for r in found if r.doc_id is not None]
    assert ids == sorted(ids)
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:i]) for i in range(len(found))]


def test_pipeline_as_a_whole(spark, tables):
    rows = contract.queries()["pipeline"](spark, tables).collect()
    again = corpus_pipeline.run(spark, tables).collect()
    key = [(r.start, r.n_tokens, r.ids_crc32) for r in rows]
    assert sorted(key) == sorted((r.start, r.n_tokens, r.ids_crc32) for r in again)
    assert key


def scratch_folders(spark):
    root = Path(scratch_folder(spark, "none").removeprefix("file:")).parent
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_a_run_leaves_its_result_and_the_token_files(spark, tables):
    before = scratch_folders(spark)
    rows = corpus_pipeline.run(spark, tables)
    left = sorted(name.rsplit("-", 1)[0] for name in scratch_folders(spark) - before)
    assert left == ["tripmart-pipeline-token_files", "tripmart-tokens"]
    assert rows.count() > 0


def test_rounds_of_components_replace_each_other(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    before = scratch_folders(spark)
    found = connected_components(links)
    left = sorted(name.rsplit("-", 1)[0] for name in scratch_folders(spark) - before)
    assert left == ["tripmart-links", "tripmart-parents"]
    assert found.filter("component <> 0").isEmpty() and found.count() == 61


def test_pipeline_without_documents(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
