import pytest
from pyspark.sql import functions as F

from plexus.operators import graph as C
from plexus.sources.classes import PropertyGraph, agreed_properties, connection_table, entity_table, jdbc_table
from plexus.sources import profile


@pytest.fixture(scope="module")
def five(spark):
    keys = spark.range(5).withColumnRenamed("id", "k")
    src = entity_table(keys, "SourceNode", "k", {"source_key": "k"})
    dst = entity_table(keys, "DestinationNode", "k", {"destination_key": "k"})
    edge = connection_table(keys.select("k", F.col("k").alias("j")), "edge", "k", ("SourceNode", "k"), ("DestinationNode", "j"),
                            {"edge_key": "k"})
    return src, dst, edge


def test_joins(five):
    src, dst, edge = five
    joined = C.edge_join(src, edge, dst)
    assert joined.count() == 5
    assert joined.where("src.source_key = dst.destination_key").count() == 5
    two = src.where("source_key < 2").select("_uniqueid")
    assert C.edges_by_endpoints(edge, two).count() == 2
    assert C.edges_by_endpoints(edge, two, dst.where("destination_key = 1").select("_uniqueid")).count() == 1
    assert C.edges_by_endpoints(edge, where=F.col("edge_key") > 2).count() == 2


def test_sql_views(spark, five):
    src, dst, edge = five
    PropertyGraph({"SourceNode": src, "DestinationNode": dst}, {"edge": edge}).register("t1_")
    n = spark.sql("""SELECT source_key, destination_key FROM t1_entity_SourceNode a JOIN t1_connection_edge b ON a._uniqueid = b._src
                     JOIN t1_entity_DestinationNode c ON b._dst = c._uniqueid WHERE source_key = destination_key""").count()
    assert n == 5
    assert spark.table("t1_system_Entity").count() == 10


def test_several_shapes_of_one_class(spark):
    d = spark.createDataFrame([(1, 10, 20)], "p int, s int, c int")
    edges = connection_table(d, "Reused", "p", ("Person", "p"), ("School", "s")).unionByName(
        connection_table(d, "Reused", "p", ("Person", "p"), ("College", "c")))
    got = {(r.src_class, r.dst_class, r.matched) for r in profile.describe_connections(edges).collect()}
    assert got == {("Person", "School", 1), ("Person", "College", 1)}


def test_conflicting_property_is_dropped(spark):
    a = spark.createDataFrame([("x", 1, "s")], "_uniqueid string, n int, p string")
    b = spark.createDataFrame([("y", 2.0, 1)], "_uniqueid string, n double, p int")
    assert set(agreed_properties({"A": a, "B": b})) == {"_uniqueid", "n"}
    assert PropertyGraph({"A": a, "B": b}).entity().columns == ["_uniqueid", "class", "n"]


@pytest.fixture(scope="module")
def star(spark):
    """A hub with 1,000 spokes (a third of the edges go out of it) and 2,000 single edges."""
    hub = spark.range(1000).select(F.lit("hub").alias("_src"), F.concat(F.lit("n"), "id").alias("_dst"))
    rest = spark.range(2000).select(F.concat(F.lit("s"), "id").alias("_src"), F.concat(F.lit("n"), "id").alias("_dst"))
    edges = hub.unionByName(rest).withColumn("class", F.lit("e"))
    nodes = edges.select(F.col("_dst").alias("_uniqueid")).distinct()
    return nodes, edges


def test_hot_source_comes_in_parts_without_loss(spark, star):
    nodes, edges = star
    ref = edges.select(F.col("_src").alias("_uniqueid")).distinct()
    got = C.group_by_source(ref, edges, nodes, max_items=100).select("_src", "part", F.size("items").alias("n")).collect()
    hub = [r for r in got if r._src == "hub"]
    assert len(hub) > 5 and sum(r.n for r in hub) == 1000 and sum(r.n for r in got) == 3000
    assert all(r.part == 0 for r in got if r._src != "hub")


def test_directions_and_distinct_nodes(spark, star):
    nodes, edges = star
    hub = spark.createDataFrame([("hub",)], "_uniqueid string")
    assert C.is_connected_to(nodes, hub, edges, "out").count() == 1000
    assert C.is_connected_to(nodes, hub, edges, "in").count() == 0
    back = C.k_hop(hub, [{"direction": "out"}, {"direction": "in"}], edges)
    assert back.count() == 1001
    with pytest.raises(ValueError):
        C.neighbour_ids(hub, edges, "sideways")


def test_merge_properties(spark):
    files = spark.createDataFrame([("a.pdf",), ("b.pdf",)], "filename string")
    props = spark.createDataFrame([("a.pdf", "me"), ("c.pdf", "you")], "filename string, owner string")
    assert {tuple(r) for r in C.merge_properties(files, props).collect()} == {("a.pdf", "me"), ("b.pdf", None)}
    assert C.merge_properties(files, props, "only_matched").count() == 1
    with pytest.raises(ValueError, match="1 files without"):
        C.merge_properties(files, props, error_missing=True)


PERSONS = [(1, "Ann", "Lee", 41, b"\xff\xd8\xff\x00", 1), (2, "Bo", None, 20, None, 2), (3, "Cy", "Fox", 33, None, 9), (4, "Di", "Ray", 50, None, None)]


@pytest.fixture(scope="module")
def people(spark):
    p = spark.createDataFrame(PERSONS, "pk_id int, first_name string, last_name string, age int, blob_personalimage binary, fk_employer_id int")
    e = spark.createDataFrame([(1, "Acme"), (2, "Bolt")], "id int, name string")
    return p, e


def test_relational_load(people):
    person, employer = people
    tables = {"person": person, "employer": employer}
    keys = {"person": "pk_id", "employer": "id"}
    fks = profile.foreign_key_candidates(tables, keys)
    assert fks == {"person.fk_employer_id": "employer.id"}
    assert profile.foreign_key_candidates(tables, keys, {"person.fk_employer_id": ""}) == {}
    row = profile.discover_fks(tables, keys).first()
    assert (row.n_matched, row.n_unmatched, row.n_null) == (2, 1, 1)
    roles = {r.column_name: r.column_role for r in profile.classify_tables(
        {"person": person}, keys, image_tables=["person"], foreign_keys=list(fks)).collect()}
    assert roles["blob_personalimage"] == "binary" and roles["pk_id"] == "key" and roles["fk_employer_id"] == "foreign_key"
    assert "blob_personalimage" not in {r.column_name for r in profile.classify_tables({"person": person}, keys).collect()}
    for bad in (dict(error_on_unused_binary=True), dict(url_columns=["person.age"])):
        with pytest.raises(ValueError):
            profile.classify_tables({"person": person}, keys, **bad)
    with pytest.raises(ValueError):
        profile.classify_tables({"employer": employer}, keys, pdf_tables=["employer"])
    edges = C.fk_edges(person, employer, prefix="postgres://h/d", source_table="person", target_table="employer",
                       source_key="pk_id", fk_column="fk_employer_id", target_key="id")
    assert edges.count() == 2 and edges.first()["class"] == "PersontoEmployer"
    assert [r.pk_id for r in C.dangling_edges(person, employer, "fk_employer_id", "id").collect()] == [3]


def test_key_that_is_no_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert profile.classify_tables({"t": df}, {"t": "k"}).first().key_ok is False


def test_foreign_key_names_with_underscores(spark):
    a = spark.createDataFrame([(1,)], "big_id int")
    tables = {"my_big": a, "my": a, "c": spark.createDataFrame([(1,)], "fk_my_big_big_id int")}
    assert profile.foreign_key_candidates(tables, {"my_big": "big_id"}) == {"c.fk_my_big_big_id": "my_big.big_id"}


def test_missing_column_is_an_error(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="no column y"):
        jdbc_table(spark, "x", ["id", "y"], path=str(tmp_path / "x"))


class StubReader:
    """What a JDBC reader is asked for; no database may run here."""

    def __init__(self, spark, rows):
        self.spark, self.rows, self.asked = spark, rows, []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        if "min(" in self.asked[-1]["dbtable"]:
            return self.rows.selectExpr("min(id) AS low", "max(id) AS high", "count(*) AS n")
        return self.rows


def test_jdbc_ranges(spark, monkeypatch):
    from plexus.sources import classes
    rows = spark.range(10, 60).selectExpr("concat('n', id) AS name", "id")
    stub = StubReader(spark, rows)
    assert jdbc_table(stub, "t", ["name", "id"], url="jdbc:x", properties={"user": "u"}).count() == 50
    assert [o["dbtable"] for o in stub.asked] == ["t", "(SELECT min(id) AS low, max(id) AS high, count(*) AS n FROM t) AS bounds"]
    assert all(o["url"] == "jdbc:x" and o["fetchsize"] == 10_000 and o["user"] == "u" for o in stub.asked)
    monkeypatch.setattr(classes, "PARTITION_ROWS", 20)
    jdbc_table(stub, "t", ["name", "id"], url="jdbc:x")
    ranges = {k: stub.asked[-1][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    assert ranges == {"partitionColumn": "id", "lowerBound": 10, "upperBound": 60, "numPartitions": 3}
    n = len(stub.asked)
    jdbc_table(stub, "t", ["name"], url="jdbc:x", partition_column="id", bounds=(0, 9), partitions=4)  # asks for nothing else
    assert len(stub.asked) == n + 2 and stub.asked[-1]["numPartitions"] == 4 and stub.asked[-1]["upperBound"] == 10
    jdbc_table(stub, "t", ["name"], url="jdbc:x", properties={"fetchsize": "7"})  # no whole number among the columns: one task
    assert len(stub.asked) == n + 3 and stub.asked[-1]["fetchsize"] == "7"
    empty = StubReader(spark, rows.where("false"))
    assert jdbc_table(empty, "t", ["id"], url="jdbc:x").count() == 0
    with pytest.raises(ValueError, match="no column y"):
        jdbc_table(stub, "t", ["y"], url="jdbc:x")


def test_checks(spark):
    src = spark.createDataFrame([("a",), ("b",), ("c",)], "_uniqueid string")
    made = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "s string")
    assert {tuple(r) for r in C.coverage_check(src, made, "s").collect()} == {("c", "missing"), ("z", "extra")}
    assert {tuple(r) for r in C.cardinality_check(src, made, "s").collect()} == {("a", 2), ("c", 0)}
