"""What a task holds does not grow with the table."""

import glob

import pyarrow as pa
from pyspark.sql import functions as F

from plexus.operators.vectors import slices
from plexus.plans import datasets as J
from plexus.queries import datasets as Q
from plexus.session import spread

SF = "/root/testdata/sf0.001"


def test_slices_are_whole_and_bounded():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * (2_000_000 if i % 500 < 3 else 10) for i in range(2_000)]})
    parts = list(slices([batch, batch.slice(0, 0)]))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert max(p.num_rows for p in parts) <= 64 and max(len(p.column(0)[0].as_py()) for p in parts) == 2_000_000
    assert [p.num_rows for p in slices([batch.slice(3, 400)], 16)] == [16] * 25
    wide = pa.RecordBatch.from_pydict({"t": ["y" * 1_000_000] * 40})
    assert all(p.num_rows <= 4 for p in slices([wide]))


def test_segments_hold_a_slice(spark):
    """The function of the tasks makes a batch of bounded size from each slice, whatever the batch that comes in."""
    from plexus.operators import documents as D
    from plexus.operators import segments as S
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(b"a text of some words").alias("body")).coalesce(1)
    packed = S.segment(D.extract_blocks_text(docs), "doc_id", clean_only=False)
    assert packed.count() == 1000
    pages = spark.range(300).select("id", F.lit("<p>a</p>").alias("html")).coalesce(1)
    sizes = D.extract_blocks_html(pages).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n bigint").agg(F.sum("n")).first()[0]
    assert sizes == 300


def test_records_come_in_many_tasks(spark):
    """A small file is one split; its records, much larger as JSON, are dealt over the cores."""
    assert Q.records(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert Q.annotation_documents(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert spread(spark.range(5).coalesce(1), "id").count() == 5


def test_annotations_are_not_dealt_by_category(spark):
    for made in (J.box_table(Q.annotations(spark, SF)), J.polygon_table(Q.annotations(spark, SF))):
        assert "hashpartitioning(category_id" not in made._jdf.queryExecution().executedPlan().toString()


def test_annotation_documents_are_written_small(spark):
    assert Q.a17(spark, SF).count() == 3
    base = spark.conf.get("spark.checkpoint.dir")
    newest = max(glob.glob(f"{base}/annotations-*"), key=lambda p: glob.os.path.getmtime(p))
    files = glob.glob(f"{newest}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
