"""Published datasets as graph tables (J) and annotation documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.plans import datasets as J
from plexus.queries.registry import query, table
from plexus.session import shared_dir, spread
from plexus.sources.objects import ANNOTATION_SCHEMA, annotation_tables

# parts as nested movie records
_RECORDS_SQL = """(SELECT p_partkey AS movie_id, p_name AS title, p_brand || ' tag' AS tagline,
  [{'id': p_size, 'name': 'person ' || p_size, 'gender': p_size % 3, 'x': 'role ' || p_partkey, 'y': p_partkey * 10},
   {'id': p_partkey % 97 + 100, 'name': 'person ' || (p_partkey % 97 + 100), 'gender': 1, 'x': 'hero', 'y': p_partkey * 10 + 1}] AS "cast",
  [{'id': p_size + 1, 'name': 'crew ' || (p_size + 1), 'gender': 2, 'x': 'Sound', 'y': 'c' || p_partkey}] AS crew,
  CASE WHEN p_size > 5 THEN [{'id': p_size % 20, 'name': 'genre ' || (p_size % 20)}] ELSE [] END AS genres,
  [{'id': ascii(p_brand[7:7]), 'name': p_brand}] AS companies, [{'id': length(p_name), 'name': 'kw ' || length(p_name)}] AS keywords,
  [{'id': lower(p_type[1:2]), 'name': lower(p_type[1:2])}] AS languages FROM part)"""


def records(spark, sf):
    p = spread(table(spark, sf, "part"), "p_partkey")  # a record is much larger as JSON than its row
    size, key = F.col("p_size"), F.col("p_partkey")

    def item(id_, name, *more, id_name="id"):
        return F.struct(id_.alias(id_name), name.alias("name"), *more)

    def person(id_, prefix, gender, *more):
        return item(id_, F.concat(F.lit(prefix), id_), gender.alias("gender"), *more)

    cast = F.array(person(size.cast("bigint"), "person ", (size % 3).cast("int"), F.concat(F.lit("role "), key).alias("character"),
                          (key * 10).alias("cast_id")),
                   person(key % 97 + 100, "person ", F.lit(1), F.lit("hero").alias("character"), (key * 10 + 1).alias("cast_id")))
    crew = F.array(person((size + 1).cast("bigint"), "crew ", F.lit(2), F.lit("Sound").alias("department"), F.lit("Mixer").alias("job"),
                          F.concat(F.lit("c"), key).alias("credit_id")))
    genre = F.array(item((size % 20).cast("bigint"), F.concat(F.lit("genre "), size % 20)))
    company = F.array(item(F.ascii(F.substring("p_brand", 7, 1)).cast("bigint"), F.col("p_brand")))
    keyword = F.array(item(F.length("p_name").cast("bigint"), F.concat(F.lit("kw "), F.length("p_name"))))
    code = F.lower(F.substring("p_type", 1, 2))
    return p.select(
        key.alias("movie_id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("budget"), F.col("p_type").alias("overview"),
        F.lit(1.0).alias("popularity"), F.concat("p_brand", F.lit(" tag")).alias("tagline"), F.lit(5.0).alias("vote_average"),
        size.alias("vote_count"), F.to_json(cast).alias("cast"), F.to_json(crew).alias("crew"),
        F.when(size > 5, F.to_json(genre)).otherwise("[]").alias("genres"), F.to_json(company).alias("production_companies"),
        F.to_json(keyword).alias("keywords"), F.to_json(F.array(item(code, code, id_name="iso_639_1"))).alias("spoken_languages"))


def _first(lst, label):
    return (f"SELECT '{label}' AS label, id, name FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY movie_id, name) AS i FROM "
            f"(SELECT movie_id, e.id::VARCHAR AS id, e.name AS name FROM (SELECT movie_id, unnest({lst}) AS e FROM {_RECORDS_SQL}))) WHERE i = 1")


@query("j01_nested_to_graph_nodes", f"""
  SELECT 'Movie' AS label, movie_id::VARCHAR AS id, title AS name FROM {_RECORDS_SQL}
  UNION ALL {_first('genres', 'Genre')} UNION ALL {_first('companies', 'ProductionCompany')} UNION ALL {_first('keywords', 'Keyword')}
  UNION ALL {_first('languages', 'SpokenLanguage')}
  UNION ALL SELECT 'Professional', id, name FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY movie_id, l, a) AS i FROM (
    SELECT movie_id, 0 AS l, a, e.id::VARCHAR AS id, e.name AS name FROM (SELECT movie_id, unnest("cast") AS e, unnest([0, 1]) AS a FROM {_RECORDS_SQL})
    UNION ALL SELECT movie_id, 1, 0, e.id::VARCHAR, e.name FROM (SELECT movie_id, unnest(crew) AS e FROM {_RECORDS_SQL}))) WHERE i = 1""")
def j01_nodes(spark, sf):
    g = J.nested_to_graph(records(spark, sf))
    return g.nodes["Movie"].select("label", "id", F.col("title").alias("name")).unionByName(g.all_nodes.select("label", "id", "name"))


@query("j01_nested_to_graph_edges", " UNION ALL ".join(
    f"SELECT movie_id::VARCHAR AS _src, e.id::VARCHAR AS _dst, '{c}' AS class, {d} AS detail FROM (SELECT movie_id, unnest({lst}) AS e FROM {_RECORDS_SQL})"
    for lst, c, d in [('"cast"', "HasCast", "e.x || '|' || e.y"), ("crew", "HasCrew", "e.x || '|Mixer|' || e.y"), ("genres", "HasGenre", "''"),
                      ("companies", "HasProductionCompany", "''"), ("keywords", "HasKeyword", "''"), ("languages", "HasSpokenLanguage", "''")]))
def j01_edges(spark, sf):
    """All edges by class, from a stored graph."""
    g = J.store_graph(J.nested_to_graph(records(spark, sf)), shared_dir(spark, "movies"))
    out = None
    for df in g.edges.values():
        extra = [c for c in df.columns if c not in ("_src", "_dst", "class")]
        part = df.select("_src", "_dst", "class", F.concat_ws("|", *extra).alias("detail") if extra else F.lit("").alias("detail"))
        out = part if out is None else out.unionByName(part)
    return out


@query("j02_poster_and_tagline", f"""
  SELECT movie_id::VARCHAR AS _src, 'tagline_embedding_' || movie_id AS _dst, 'HasTaglineEmbedding' AS class FROM {_RECORDS_SQL}
  UNION ALL SELECT p_partkey::VARCHAR, 'image_' || p_partkey, 'HasImage' FROM part WHERE p_size > 25
  UNION ALL SELECT 'image_' || p_partkey, 'image_embedding_' || p_partkey, 'HasImageEmbedding' FROM part WHERE p_size > 25""")
def j02(spark, sf):
    from plexus.operators.models import hashed_words
    poster = F.when(F.col("vote_count") > 25, F.concat(F.lit("data:,"), F.col("movie_id")))
    movies = records(spark, sf).select(F.col("movie_id").cast("string").alias("id"), "tagline", poster.alias("poster_url"))

    def load_image():
        return lambda blobs: [[float(len(b)), 1.0] for b in blobs]

    g = J.poster_and_tagline(movies, hashed_words(16), load_image)
    return g.edges["HasTaglineEmbedding"].unionByName(g.edges["HasImage"]).unionByName(g.edges["HasImageEmbedding"])


def annotation_documents(spark, sf):
    """One annotation document per order line: its part as the image, the line as the annotation."""
    columns = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_returnflag")
    li, p = spread(table(spark, sf, "lineitem").select(*columns), "l_orderkey"), table(spark, sf, "part")
    joined = li.join(p, F.col("p_partkey") == F.col("l_partkey"))
    image = F.struct(
        F.col("p_partkey").alias("id"), F.concat(F.lit("img_"), "p_partkey", F.lit(".jpg")).alias("file_name"),
        (F.col("p_size") * 10).alias("height"), (F.col("p_size") * 20).alias("width"), F.lit(1).alias("license"),
        F.concat(F.lit("http://images.example/"), "p_partkey").alias("coco_url"),
        F.concat(F.lit("http://photos.example/x/"), "p_partkey", F.lit("_abc_o.jpg")).alias("flickr_url"),
        F.lit("2013-11-14 17:02:52").alias("date_captured"))
    corner = F.array((F.col("l_quantity") - 5), F.col("l_tax") * 10, F.col("l_quantity") * 2 + 0.5, F.col("l_discount") * 300)
    annotation = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("p_partkey").alias("image_id"),
        (F.col("l_linenumber") % 3).cast("bigint").alias("category_id"), corner.alias("bbox"), F.col("l_quantity").alias("area"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("iscrowd"),
        F.array(F.array(F.col("l_quantity"), F.col("l_tax"), F.lit(1.5), F.lit(2.5), F.lit(3.0), F.lit(4.0))).alias("segmentation"))
    category = F.struct((F.col("l_linenumber") % 3).cast("bigint").alias("id"), F.concat(F.lit("cat_"), F.col("l_linenumber") % 3).alias("name"))
    text = F.to_json(F.struct(F.array(image).alias("images"), F.array(annotation).alias("annotations"), F.array(category).alias("categories")))
    return joined.select(text.alias("value"), F.when(F.col("p_size") > 10, "train").otherwise("val").alias("corpus"))


def annotations(spark, sf):
    parsed = annotation_documents(spark, sf).withColumn("d", F.from_json("value", ANNOTATION_SCHEMA)).select("corpus", "d.*")
    t = annotation_tables(parsed)
    t.images = t.images.dropDuplicates(["id"])  # equal rows: the same part in several documents
    return t


_A = "(SELECT *, l_orderkey * 10 + l_linenumber AS ann, CASE WHEN p_size > 10 THEN 'train' ELSE 'val' END AS corpus FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query("a17_annotations_json", f"""
  SELECT 'image' AS kind, count(DISTINCT p_partkey) AS n_rows FROM {_A} UNION ALL SELECT 'annotation', count(*) FROM {_A}
  UNION ALL SELECT 'category', count(DISTINCT l_linenumber % 3) FROM {_A}""")
def a17(spark, sf):
    from plexus.sources.objects import annotations_json
    path = shared_dir(spark, "annotations")
    annotation_documents(spark, sf).select("value").write.text(path, compression="gzip")  # one document per line, a file per task
    t = annotations_json(spark, path, multi_line=False)
    n = F.count(F.lit(1)).alias("n_rows")
    return (t.images.select("id").distinct().agg(n).select(F.lit("image").alias("kind"), "n_rows")
            .unionByName(t.annotations.agg(n).select(F.lit("annotation").alias("kind"), "n_rows"))
            .unionByName(t.categories.agg(n).select(F.lit("category").alias("kind"), "n_rows")))


@query("j03_image_table", f"""
  SELECT DISTINCT 'img/img_' || p_partkey || '.jpg' AS filename, p_partkey AS id, p_size * 10 AS height, p_size * 20 AS width, 1 AS license,
    'http://images.example/' || p_partkey AS coco_url, '2013-11-14T17:02:52' AS date_captured, 2.0::DOUBLE AS aspect_ratio,
    p_partkey::VARCHAR AS yfcc_id, corpus FROM {_A}""")
def j03(spark, sf):
    return J.image_table(annotations(spark, sf), "img").select(
        "filename", "id", "height", "width", "license", "coco_url", "date_captured", "aspect_ratio", "yfcc_id", "corpus")


def _clamp(e):
    return f"CASE WHEN trunc({e}) > 0 THEN trunc({e})::INT ELSE 1 END"


@query("j04_box_table", f"""
  SELECT p_partkey AS image_id, {_clamp('l_quantity - 5')} AS x_pos, {_clamp('l_tax * 10')} AS y_pos, {_clamp('l_quantity * 2 + 0.5')} AS box_width,
    {_clamp('l_discount * 300')} AS box_height, ann AS bbox_id, l_linenumber % 3 AS category_id, l_quantity AS area,
    l_quantity / ((p_size * 20)::DOUBLE * (p_size * 10)::DOUBLE) AS area_perc, (l_returnflag = 'R')::INT AS is_crowd, 'cat_' || (l_linenumber % 3) AS _label, corpus
  FROM {_A}""")
def j04_boxes(spark, sf):
    return J.box_table(annotations(spark, sf))


@query("j04_polygon_table", f"""
  SELECT p_partkey AS image_id, ann AS ann_id, 'cat_' || (l_linenumber % 3) AS _label, corpus, 3 AS n_points, round(l_tax, 4) AS first_y FROM {_A}
  WHERE l_returnflag <> 'R' AND ann NOT IN (112058, 439437, 1739161, 1746989, 1889299, 1903692, 43101, 66776, 72306, 81707, 84930, 100074, 106259,
    128551, 129193, 138704, 175423, 206849, 211109, 217875, 264532, 265143, 458930, 497030, 512331, 710934, 1053842, 1258446, 1271939, 1301323, 1818283, 918, 2206849)""")
def j04_polygons(spark, sf):
    ring = F.get("polygons", F.lit(0))
    return J.polygon_table(annotations(spark, sf)).select(
        "image_id", "ann_id", "_label", "corpus", F.size(ring).alias("n_points"),
        F.round(F.get(F.get(ring, F.lit(0)), F.lit(1)), 4).alias("first_y"))


@query("j05_mask_edges", f"""
  SELECT DISTINCT 'seg/img_' || p_partkey || '.png' AS filename, p_partkey::VARCHAR AS _src, 'seg_' || p_partkey AS _dst, corpus FROM {_A}""")
def j05(spark, sf):
    masks, edges = J.mask_edges(annotations(spark, sf), "seg")
    return masks.select("filename", F.col("seg_id").alias("id")).join(edges, "id").select("filename", "_src", "_dst", "corpus")


@query("j06_attribute_columns", """
  SELECT 'faces/' || lpad(c_custkey::VARCHAR, 6, '0') || '.jpg' AS filename, 'cropped_' || lpad(c_custkey::VARCHAR, 6, '0') AS image_id,
    CASE WHEN c_acctbal > 0 THEN 1 ELSE -1 END AS "Smiling", n_regionkey AS x_1 FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def j06(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    name = F.concat(F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit(".jpg")).alias("image_id")
    attributes = c.select(name, F.when(F.col("c_acctbal") > 0, 1).otherwise(-1).alias("Smiling"))
    boxes = c.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(name, F.col("n_regionkey").alias("x_1"))
    return J.attribute_columns(attributes, boxes, "faces")


@query("j07_id_mapping_limit", "SELECT o_orderkey AS idx, o_custkey AS orig_idx FROM orders WHERE o_custkey <= 500")
def j07(spark, sf):
    return J.id_mapping_limit(table(spark, sf, "orders").select(F.col("o_orderkey").alias("idx"), F.col("o_custkey").alias("orig_idx")), 500)
