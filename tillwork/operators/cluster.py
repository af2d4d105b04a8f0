"""k-means sweeps and assignment, and the two-component projection."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators import kmeans
from tillwork.operators.encode import moments, standardize
from tillwork.operators.models import persisted
from tillwork.session import cut


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


def kmeans_sweep(
    df: DataFrame,
    features: Sequence[str],
    ks: Sequence[int] = range(2, 11),
    max_iter: int = 100,
    restarts: int = 10,
    seed: int = 42,
) -> tuple[DataFrame, dict[int, kmeans.Fit]]:
    """(k, wcss, silhouette) on standardized features, and the best fit of each k.

    All numbers of clusters and all their restarts advance in the same passes over the rows. The
    silhouette uses squared distances, which needs a few passes instead of all pairs of rows.
    """
    with persisted(kmeans.packed(cut(standardize(df, features).select(*features)), features)) as rows:
        fits = kmeans.best_fits(kmeans.fit_many(rows, features, ks, restarts, max_iter, seed=seed))
        scores = kmeans.silhouettes(rows, features, [fits[k] for k in ks])
    table = [(k, fits[k].cost, score) for k, score in zip(ks, scores)]
    return df.sparkSession.createDataFrame(table, "k int, wcss double, silhouette double"), fits


def best_k(sweep: DataFrame) -> int:
    """k with the highest silhouette; the smallest wins ties."""
    return sweep.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]


def assign_to(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster``: index of the nearest of the given centres, the first on ties."""

    def squared(centre: Sequence[float]) -> Column:
        terms = [(F.col(c) - F.lit(float(v))) for c, v in zip(features, centre)]
        total = terms[0] * terms[0]
        for t in terms[1:]:
            total = total + t * t
        return total

    distances = F.array(*[squared(c) for c in centres])
    nearest = F.array_position(distances, F.array_min(distances)) - 1
    return df.withColumn("cluster", nearest.cast("int"))


def kmeans_centroids(df: DataFrame, features: Sequence[str], fit: kmeans.Fit) -> DataFrame:
    """Centroids in original units, of a fit on standardized features, with cluster sizes."""
    fitted = moments(df, features)
    rows = [
        (i, int(size), *[float(v * (fitted[c][1] or 1.0) + fitted[c][0]) for c, v in zip(features, centre)])
        for i, (centre, size) in enumerate(zip(fit.centres, fit.sizes))
    ]
    schema = "cluster int, n long, " + ", ".join(f"{c} double" for c in features)
    return df.sparkSession.createDataFrame(rows, schema)


def projected_centroids(spark: SparkSession, fit: kmeans.Fit, loadings: np.ndarray) -> DataFrame:
    """Centroids of a fit on standardized features in the plane of their principal components."""
    rows = [(i, *map(float, point)) for i, point in enumerate(fit.centres @ loadings)]
    schema = "cluster int, " + ", ".join(f"pc{i + 1} double" for i in range(loadings.shape[1]))
    return spark.createDataFrame(rows, schema)


def cluster_counts(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n")).orderBy(F.desc("n"), cluster)


def pca_2d(df: DataFrame, features: Sequence[str], k: int = 2) -> tuple[DataFrame, np.ndarray]:
    """Add ``pc1..pck`` for standardized features; returns the loadings as well.

    Standardized columns are centred already. Signs are fixed so that the loading of the largest
    magnitude is positive.
    """
    vectors = assemble(standardize(df, features), features, "__v")
    model = PCA(k=k, inputCol="__v", outputCol="__pc").fit(vectors)
    loadings = model.pc.toArray()
    # Among equal magnitudes the first counts, however they were rounded.
    signs = [1.0 if col[np.argmax(np.abs(col).round(9))] >= 0 else -1.0 for col in loadings.T]
    projected = model.transform(vectors).withColumn("__pc", vector_to_array("__pc"))
    out = projected.withColumns(
        {f"pc{i + 1}": F.col("__pc")[i] * F.lit(sign) for i, sign in enumerate(signs)}
    )
    original = {c: df[c] for c in df.columns}
    return out.drop("__v", "__pc").select(*original, *[f"pc{i + 1}" for i in range(k)]), loadings * signs
