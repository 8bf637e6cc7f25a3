"""PCA / SVD / covariance (A-01..A-08, J-17) and the distributed transpose (E-10)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decompose as D
from ..operators import features as FE
from ..operators import reshape
from ..session import cut_lineage, shuffle_width
from ..sources.tables import read_table

WIDTH = 64
TERM_PATTERN = r"[^\p{L}]+"


def _embeddings(spark, sf_dir) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return FE.array_vector(emb, "embedding", "features")


def q_pca_components(spark, sf_dir):
    """Loadings of the first two principal components of the embeddings (A-01, A-03, A-07)."""
    model = D.pca(_embeddings(spark, sf_dir), 2)
    return D.components_table(spark, model, [f"f{i}" for i in range(WIDTH)])


def q_pca_variance(spark, sf_dir):
    """Explained variance of each kept component, as a share of the total (A-01, A-06)."""
    return D.variance_table(spark, D.pca(_embeddings(spark, sf_dir), 2))


def q_pca_project(spark, sf_dir):
    """Every embedding projected on the first two components (A-01, A-04)."""
    data = _embeddings(spark, sf_dir)
    return D.project(D.pca(data, 2), data, ["vec_id"])


def q_covariance(spark, sf_dir):
    """Sample covariance of the 64 embedding dimensions, i ≤ j (A-08)."""
    cov = D.covariance_table(spark, _embeddings(spark, sf_dir), names=[str(i) for i in range(WIDTH)])
    return cov.select("i", "j", F.round("cov", 9).alias("cov"))


def _cov_sql() -> str:
    cols = ", ".join(f'covar_samp(embedding[{i + 1}], embedding[{j + 1}]) AS "{i}|{j}"'
                     for i in range(WIDTH) for j in range(i, WIDTH))
    return f"""
SELECT split_part(k, '|', 1) AS i, split_part(k, '|', 2) AS j, round(cov, 9) AS cov
FROM (UNPIVOT (SELECT {cols} FROM embeddings) ON COLUMNS(*) INTO NAME k VALUE cov)"""


S_COVARIANCE = _cov_sql()


def q_matrix_size(spark, sf_dir):
    """Rows and columns of the embedding row matrix (A-02): a count and an array size."""
    emb = read_table(spark, sf_dir, "embeddings", ["embedding"])
    return emb.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size("embedding")).cast("long").alias("n_cols"))


S_MATRIX_SIZE = "SELECT count(*) AS n_rows, CAST(max(len(embedding)) AS BIGINT) AS n_cols FROM embeddings"


def q_centred_rows(spark, sf_dir):
    """Embeddings centred on the column means, scale kept (E-05), as (vec_id, dim, value)."""
    data = _embeddings(spark, sf_dir)
    centred = FE.scaler("features", "c", with_mean=True, with_std=False).fit(data).transform(data)
    arr = vector_to_array(F.col("c"))
    return (centred.select("vec_id", F.posexplode(arr).alias("dim", "value"))
                   .select("vec_id", F.col("dim").cast("int").alias("dim"), F.round("value", 9).alias("value")))


S_CENTRED_ROWS = f"""
WITH cells AS (
  SELECT vec_id, CAST(d - 1 AS INTEGER) AS dim, CAST(embedding[d] AS DOUBLE) AS x
  FROM embeddings, range(1, {WIDTH} + 1) t(d))
SELECT vec_id, dim, round(x - avg(x) OVER (PARTITION BY dim), 9) AS value FROM cells"""


def doc_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, term, n): letter-run terms of whole documents, lower-cased.

    The texts are dealt out by document, so that their terms, many times larger, are counted where they are.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).repartition(shuffle_width(spark), "doc_id")
    terms = (docs.select("doc_id", F.explode(F.split(F.lower("text"), TERM_PATTERN)).alias("term"))
                 .filter(F.col("term") != ""))
    return terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


def q_transpose_long(spark, sf_dir):
    """Word × paper counts transposed to paper × word, long form, every word (E-10)."""
    wp = doc_terms(spark, sf_dir).select(F.col("term").alias("row"), F.col("doc_id").alias("col"), "n")
    return reshape.transpose_long(wp, "row", "col").select(F.col("row").alias("doc_id"),
                                                           F.col("col").alias("term"), "n")


S_TRANSPOSE_LONG = f"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{TERM_PATTERN}')) AS term FROM documents)
SELECT doc_id, term, count(*) AS n FROM terms WHERE term <> '' GROUP BY 1, 2"""


def _paper_pca(spark, sf_dir) -> tuple[DataFrame, list[float]]:
    """Components of the standardised paper × word matrix: every paper and every word.

    The matrix stays a long table of its non-zero counts; a
    paper without words counts as a row of zeros.
    """
    papers = read_table(spark, sf_dir, "documents", ["doc_id"]).distinct().count()
    return D.centred_components(doc_terms(spark, sf_dir), papers, "doc_id", "term", "n", k=2)


def q_paper_pca(spark, sf_dir):
    """Paper PCA: transpose → standardise → top-2 components as term loadings (J-17, A-07)."""
    return _paper_pca(spark, sf_dir)[0]


def q_paper_variance(spark, sf_dir):
    """Share of total variance explained by each paper component (A-06, D-10 fixed)."""
    shares = _paper_pca(spark, sf_dir)[1]
    return spark.createDataFrame([(i + 1, s) for i, s in enumerate(shares)],
                                 "component int, explained_variance double")


def _standardised(spark, sf_dir) -> DataFrame:
    data = _embeddings(spark, sf_dir)
    return cut_lineage(FE.scaler("features", "z").fit(data).transform(data)
                       .select("vec_id", F.col("z").alias("features")), "svd-input")


def q_svd_eigen(spark, sf_dir):
    """Truncated SVD (k=2) of the standardised embeddings: s, s², shares (A-05, A-06)."""
    std = _standardised(spark, sf_dir)
    res = D.svd(std, 2)
    # total variance = sum of column variances: one distributed aggregate.
    stats = std.select(Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")).first()["s"]
    return D.eigen_table(spark, res.s, float(sum(stats["variance"].toArray())), int(stats["count"]))


def q_svd_u(spark, sf_dir):
    """Left singular vectors of the standardised embeddings, per vector and component (A-05)."""
    std = _standardised(spark, sf_dir)
    return D.left_vectors(std, D.svd(std, 2), "vec_id")


def q_svd_v(spark, sf_dir):
    """Right singular vectors of the standardised embeddings, per dimension and component (A-05)."""
    return D.right_vectors(spark, D.svd(_standardised(spark, sf_dir), 2))


def q_principal_components(spark, sf_dir):
    """Top-2 principal components of the embedding row matrix (A-03)."""
    pc = D.principal_components(_embeddings(spark, sf_dir), 2).toArray()
    return spark.createDataFrame([(i, j + 1, float(pc[i, j])) for i in range(pc.shape[0]) for j in range(pc.shape[1])],
                                 "dim int, component int, loading double")


QUERIES = {
    "svd_u": q_svd_u,
    "svd_v": q_svd_v,
    "principal_components": q_principal_components,
    "pca_components": q_pca_components,
    "pca_variance": q_pca_variance,
    "pca_project": q_pca_project,
    "covariance": q_covariance,
    "matrix_size": q_matrix_size,
    "centred_rows": q_centred_rows,
    "transpose_long": q_transpose_long,
    "paper_pca": q_paper_pca,
    "paper_variance": q_paper_variance,
    "svd_eigen": q_svd_eigen,
}

ORACLES = {
    "covariance": S_COVARIANCE,
    "matrix_size": S_MATRIX_SIZE,
    "centred_rows": S_CENTRED_ROWS,
    "transpose_long": S_TRANSPOSE_LONG,
}
