"""Ranking by vectors: queries D1 to D8 and the vector source A5."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeseek.functions import values as vx
from placeseek.operators import semantic
from placeseek.plans import shared
from placeseek.plans.registry import query
from placeseek.session import work_path
from placeseek.sources import vectors as vs
from placeseek.sources.tables import posts_from_documents, table

NEAREST = 10


def _stored(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _squares(vector):
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


@query(
    "a5_vectors_from_blocks",
    """SELECT vec_id AS id, len(embedding) AS dims, round(embedding[1]::DOUBLE, 6) AS first_value,
       round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS squares FROM embeddings""",
)
def vectors_from_blocks(spark, folder):
    """Pack rows into blocks with a parallel id list, and read them back."""
    rows = vs.unpack_blocks(vs.pack_blocks(_stored(spark, folder)))
    return rows.select(
        "id",
        F.size("embedding").cast("long").alias("dims"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"),
        F.round(_squares("embedding"), 6).alias("squares"),
    )


@query(
    "d1_encode_hashed",
    f"""WITH {shared.BOTH_ENCODED}
SELECT CAST(substr(key, 2) AS BIGINT) AS id, unnest(range(64)) AS pos, round(unnest(vec), 6) AS v
FROM encoded WHERE key[1] = 'd'""",
)
def encode_hashed(spark, folder):
    return shared.corpus_vectors(spark, folder).select(
        "id", F.posexplode("embedding").alias("pos", "v")
    ).select("id", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias("v"))


def _letters_model():
    """A stand-in for a user's model: length, words and one letter of each text."""
    import numpy as np

    def predict(texts):
        return np.array([[len(t), t.count(" "), t.count("e")] for t in texts], dtype=np.float32)

    return predict


@query(
    "d1_encode_model",
    """SELECT doc_id AS id, CAST(length(text) AS DOUBLE) AS letters, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS blanks,
       CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS es FROM documents""",
)
def encode_model(spark, folder):
    """A user's model over half of the posts, then over all: the second run encodes the rest."""
    posts = posts_from_documents(spark, folder, ("id", "content"))
    path = work_path(spark, "encoded")

    def encode(rows):
        return semantic.encode_with(rows, "text", _letters_model)

    vs.upsert_vectors(posts.filter("id % 2 = 0"), path, encode, "content")
    vectors = vs.upsert_vectors(posts, path, encode, "content")
    at = [F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate(("letters", "blanks", "es"))]
    return vectors.select("id", *at)


@query(
    "d4_encode_queries",
    f"""WITH {shared.BOTH_ENCODED}
SELECT CAST(substr(key, 2) AS BIGINT) AS query_id, unnest(range(64)) AS pos, round(unnest(vec), 6) AS v
FROM encoded WHERE key[1] = 'q'""",
)
def encode_queries(spark, folder):
    encoded = shared.encode_queries(shared.benchmark_queries(spark, folder))
    return encoded.select("query_id", F.posexplode("embedding").alias("pos", "v")).select(
        "query_id", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias("v")
    )


POOLED = """
marked AS (
  SELECT e.label, CAST(coalesce(l.quality, 0) AS DOUBLE) AS m, unnest(range(64)) AS pos,
         unnest(embedding)::DOUBLE AS v
  FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id),
pooled AS (SELECT label, pos, sum(v * m) / greatest(sum(m), 1e-9) AS v FROM marked GROUP BY label, pos)"""

CENTRES = f"""{POOLED},
lens AS (SELECT label, greatest(sqrt(sum(v * v)), 1e-12) AS len FROM pooled GROUP BY label),
centres AS (SELECT label, list(v / len ORDER BY pos) AS vec FROM pooled JOIN lens USING (label) GROUP BY label)"""


def _pooled(spark, folder):
    """Mean vector of each label over the vectors whose document has good quality."""
    marks = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality")
    marked = _stored(spark, folder).join(marks, "id", "left")
    return semantic.mean_pool(
        marked, ["label"], "embedding", F.coalesce(F.col("quality"), F.lit(0))
    )


def _centres(spark, folder):
    return _pooled(spark, folder).select(
        F.col("label").cast("long").alias("query_id"), vx.unit(F.col("embedding")).alias("embedding")
    )


@query("d2_mean_pooling", f"WITH {POOLED} SELECT label, pos, round(v, 6) AS v FROM pooled")
def mean_pooling(spark, folder):
    return _pooled(spark, folder).select(
        "label", F.posexplode("embedding").alias("pos", "v")
    ).select("label", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias("v"))


@query(
    "d3_unit_vectors",
    """SELECT vec_id AS id, unnest(range(64)) AS pos,
       round(unnest(embedding)::DOUBLE * 3 / greatest(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * 3, 1e-12), 6) AS v
FROM embeddings""",
)
def unit_vectors(spark, folder):
    """Vectors of three times the length, brought back to length one."""
    longer = F.transform("embedding", lambda x: x.cast("double") * 3)
    rows = _stored(spark, folder).select("id", longer.alias("x")).select("id", vx.unit(F.col("x")).alias("x"))
    return rows.select("id", F.posexplode("x").alias("pos", "v")).select(
        "id", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias("v")
    )


@query(
    "d5_posts_with_vectors",
    f"""WITH {shared.POSTS}
SELECT p.id, p.page_url, len(e.embedding) AS dims FROM posts p JOIN embeddings e ON e.vec_id = p.id""",
)
def posts_with_vectors(spark, folder):
    posts = posts_from_documents(spark, folder, ("id", "page_url"))
    joined = semantic.with_vectors(posts, _stored(spark, folder).drop("label"), strict=False)
    return joined.select("id", "page_url", F.size("embedding").cast("long").alias("dims"))


@query(
    "d5_posts_without_vectors",
    "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
)
def posts_without_vectors(spark, folder):
    return semantic.missing_vectors(
        posts_from_documents(spark, folder, ("id",)), _stored(spark, folder)
    )


@query(
    "d6_knn_l2",
    f"""WITH {CENTRES},
gaps AS (
  SELECT CAST(label AS BIGINT) AS query_id, vec_id AS id,
         round(greatest(list_inner_product(c.vec, c.vec) + list_inner_product(v.x, v.x) - 2 * list_inner_product(c.vec, v.x), 0), 6) AS distance
  FROM centres c CROSS JOIN (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings) v)
SELECT query_id, rank, id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM gaps)
WHERE rank <= {NEAREST}""",
)
def knn_l2(spark, folder):
    """The stored vectors nearest to the centre of each label."""
    return semantic.nearest(_stored(spark, folder), _centres(spark, folder), NEAREST)


@query(
    "d6_knn_l2_batch",
    f"""WITH {shared.sql_near(NEAREST)} SELECT query_id, rank, id, distance FROM near""",
)
def knn_l2_batch(spark, folder):
    """Every benchmark text against every document vector."""
    queries = shared.encode_queries(shared.benchmark_queries(spark, folder))
    return semantic.nearest(shared.corpus_pivots(spark, folder), queries, NEAREST)


@query(
    "d7_position_lookup",
    f"""WITH {shared.sql_near(NEAREST)}
SELECT query_id, rank, n.id, d.source AS blog_url, split_part(d.text, chr(10), 1) AS page_title
FROM near n JOIN documents d ON d.doc_id = n.id""",
)
def position_lookup(spark, folder):
    from placeseek.operators.hits import attach_posts

    posts = posts_from_documents(spark, folder, ("id", "blog_url", "page_url", "page_title"))
    found = attach_posts(knn_l2_batch(spark, folder), posts, key="id")
    return found.select("query_id", "rank", "id", "blog_url", "page_title")
