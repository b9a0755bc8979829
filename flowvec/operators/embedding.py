"""Embedding rows and texts: encoder hook, hashed features, trained and pooled vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, HashingTF, Normalizer, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.functions import vectors as V
from flowvec.operators import text as T
from flowvec.operators.pairwise import to_matrix
from flowvec.session import lookup_join

Encoder = Callable[[Sequence[str]], np.ndarray]

# Widths of the model outputs.
ZERO_DIM, PROJECTION_HIDDEN, PROJECTION_DIM = 384, 256, 128
HASH_DIM = 256
DEFAULT_TEXT = "empty"
# Tasks that train side by side and whose updates are averaged.
TRAINERS = 8


def embed(
    df: DataFrame,
    text_col: str,
    load: Callable[[], Encoder],
    name: str = "embedding",
    on_error: str = "raise",
):
    """Apply a user's encoder to Arrow batches; ``load`` runs once per worker.

    A batch the encoder fails on ends the job, or with ``on_error="null"`` gets
    null vectors; see :func:`fill_failed`.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error is 'raise' or 'null'")

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            try:
                vectors = np.asarray(encoder(texts.fillna("").tolist()), dtype=np.float32)
                yield pd.Series(list(vectors))
            except Exception:  # the hook is user code: any failure marks the batch
                if on_error == "raise":
                    raise
                yield pd.Series([None] * len(texts))

    return df.withColumn(name, encode(F.col(text_col)))


def hashed(df: DataFrame, tokens_col: str, dim: int = HASH_DIM, name: str = "embedding"):
    """Unit vector of hashed token counts; the JVM does the hashing.  No tokens, zeros."""
    counts = HashingTF(numFeatures=dim, inputCol=tokens_col, outputCol="_tf").transform(df)
    unit = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit").transform(counts)
    return unit.withColumn(name, vector_to_array("_unit", "float32")).drop("_tf", "_unit")


def hashed_text(df: DataFrame, text_col: str, dim: int = HASH_DIM, name: str = "embedding"):
    """:func:`hashed` over the lower-case words and numbers of a text."""
    parts = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return hashed(df.withColumn("_tokens", parts), "_tokens", dim, name).drop("_tokens")


def train_word2vec(
    sentences: DataFrame,
    tokens_col: str,
    size: int = 10,
    window: int = 2,
    min_count: int = 1,
    epochs: int = 50,
    seed: int = 42,
    trainers: int = TRAINERS,
) -> Word2VecModel:
    """Skip-gram token vectors, trained alike at every size.

    The vocabulary must fit the driver, as Spark ML keeps it there; vectors
    without that bound are those of :mod:`flowvec.operators.cooccurrence`.
    """
    return Word2Vec(
        vectorSize=size,
        windowSize=window,
        minCount=min_count,
        maxIter=epochs,
        seed=seed,
        numPartitions=trainers,
        inputCol=tokens_col,
        outputCol="_w2v",
    ).fit(sentences)


def token_vectors(model: Word2VecModel) -> DataFrame:
    """``token, vector`` of a trained model."""
    found = model.getVectors()
    return found.select(F.col("word").alias("token"), vector_to_array("vector").alias("vector"))


def mean_of_tokens(
    df: DataFrame, key: str, tokens_col: str, vectors: DataFrame, dim: int, name: str = "embedding"
) -> DataFrame:
    """Mean vector of the known tokens of each row; none known gives zeros."""
    tokens = df.select(key, F.explode(tokens_col).alias("token"))
    known = lookup_join(tokens, vectors, ["token"], "inner", max_rows=2_000_000 // max(dim, 1))
    means = known.groupBy(key).agg(
        vector_to_array(Summarizer.mean(array_to_vector(V.doubles(F.col("vector"))))).alias(name)
    )
    zeros = V.doubles(V.zeros(dim))
    return df.select(key).join(means, key, "left").withColumn(name, F.coalesce(name, zeros))


def entity_sentences(df: DataFrame, src: str, dst: str, name: str = "entities") -> DataFrame:
    """Two-word sentences of the addresses of each flow."""
    return df.select(F.array(src, dst).alias(name))


def pool_masked_mean(df: DataFrame, by: str, vec: str, mask: str, name: str = "embedding"):
    """Mean of the token vectors whose mask is set, weighted by it."""
    used = df.where(F.col(mask) > 0)
    mean = Summarizer.mean(array_to_vector(V.doubles(F.col(vec))), F.col(mask).cast("double"))
    return used.groupBy(by).agg(vector_to_array(mean).alias(name))


def pool_first(df: DataFrame, by: str, position: str, vec: str, name: str = "embedding"):
    """Vector of the first token."""
    return df.where(F.col(position) == 0).select(by, F.col(vec).alias(name))


def pool_sparse_max(df: DataFrame, by: str, term: str, value: str, mask: str, name="weight"):
    """Largest ``log(1 + relu(x))`` per term over the unmasked tokens; zeros are left out."""
    activation = F.log1p(F.greatest(F.col(value).cast("double"), F.lit(0.0))) * F.col(mask)
    return df.groupBy(by, term).agg(F.max(activation).alias(name)).where(F.col(name) > 0)


def projection_weights(inputs: int, seed: int = 42, hidden=PROJECTION_HIDDEN, out=PROJECTION_DIM):
    """Fixed random weights of the two dense layers."""
    random = np.random.default_rng(seed)
    return (
        random.uniform(-1, 1, (inputs, hidden)) / np.sqrt(inputs),
        random.uniform(-1, 1, hidden) / np.sqrt(inputs),
        random.uniform(-1, 1, (hidden, out)) / np.sqrt(hidden),
        random.uniform(-1, 1, out) / np.sqrt(hidden),
    )


def project(df: DataFrame, key: str, features: str, inputs: int, seed: int = 42) -> DataFrame:
    """Two dense layers with a rectifier between them, applied to Arrow batches."""
    weights = df.sparkSession.sparkContext.broadcast(projection_weights(inputs, seed))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w1, b1, w2, b2 = weights.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = np.maximum(to_matrix(batch["f"]) @ w1 + b1, 0) @ w2 + b2
            offsets = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
            vectors = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()).cast(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch["k"], vectors], names=["k", "embedding"])

    rows = df.select(F.col(key).cast("long").alias("k"), F.col(features).alias("f"))
    return rows.mapInArrow(apply, "k long, embedding array<float>").withColumnRenamed("k", key)


def reconstruction_error(df: DataFrame, key: str, vec: str, k: int) -> DataFrame:
    """Squared error after projecting centred vectors to ``k`` components and back."""
    points = df.select(key, array_to_vector(V.doubles(F.col(vec))).alias("x"))
    model = PCA(k=k, inputCol="x", outputCol="y").fit(points)
    basis = model.pc.toArray()
    mean = points.select(Summarizer.mean(F.col("x")).alias("m")).first()["m"].toArray()
    shared = df.sparkSession.sparkContext.broadcast((basis, mean))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, mean = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            centered = to_matrix(batch["v"]) - mean
            error = ((centered - centered @ basis @ basis.T) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(error)], names=["k", "error"])

    rows = df.select(F.col(key).cast("long").alias("k"), V.doubles(F.col(vec)).alias("v"))
    return rows.mapInArrow(score, "k long, error double").withColumnRenamed("k", key)


def zero_embedding(df: DataFrame, dim: int = ZERO_DIM, name: str = "embedding") -> DataFrame:
    return df.withColumn(name, V.zeros(dim))


def fill_failed(df: DataFrame, vec: str, dim: int, valid: str = "valid") -> DataFrame:
    """Flag usable vectors and put zeros in place of the others."""
    good = V.has_dim(F.col(vec), dim)
    zeros = F.array_repeat(F.lit(0.0).cast(df.schema[vec].dataType.elementType), dim)
    return df.withColumn(valid, good).withColumn(
        vec, F.when(F.col(valid), F.col(vec)).otherwise(zeros)
    )


def text_or_default(c: Column, default: str = DEFAULT_TEXT) -> Column:
    stripped = T.strip(c)
    return F.when(F.coalesce(stripped, F.lit("")) == "", F.lit(default)).otherwise(c)
