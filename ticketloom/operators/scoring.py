"""Scoring with a caller-supplied model (V1), ticket-type classifiers fitted
on the table (V2: naive Bayes, and TF-IDF with logistic regression) and
keyword-based domain labels (V4).

V1 is the one place where Python runs per batch: ``mapInArrow`` hands the
model the texts of Arrow batches, cut by bytes, and the model is built once
per task (a model load is expensive), never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.fixed_values import OUT_OF_DOMAIN_ERROR
from ticketloom.functions.text import ascii_words
from ticketloom.session import ship_package

SLICE_BYTES = 1 << 20       # of rows that are Python objects at once

ModelFactory = Callable[[], Callable[[pd.Series], pd.Series]]


def score(df: DataFrame, model_factory: ModelFactory, text_col: str = "user_input",
          out: str = "response") -> DataFrame:
    """Adds ``out`` = model(text) for every row, batch by batch.  A batch, which Spark fills by number of
    rows, is cut into slices of about ``SLICE_BYTES``, and the texts alone become Python objects, so
    long texts and other columns don't add up in the worker."""
    ship_package(df.sparkSession)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_factory()
        for batch in batches:
            rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
            for k in range(0, batch.num_rows, rows):
                part = batch.slice(k, rows)
                texts = pd.DataFrame({"text": part.column(text_col).to_pandas()})
                texts["out"] = model(texts["text"]).astype(object)
                replies = pa.array(texts["out"], pa.string(), from_pandas=True)
                yield pa.RecordBatch.from_arrays([*part.columns, replies], [*batch.schema.names, out])
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def rule_model() -> Callable[[pd.Series], pd.Series]:
    """A deterministic stand-in for a generative model: returns replies in
    the decoder's shape ('[INST] ... [/INST] {json}') from keyword rules."""
    def reply(text) -> str:
        t = (text or "").lower()
        if any(w in t for w in ("weather", "recipe", "movie", "joke")):
            body = '{"error": "' + OUT_OF_DOMAIN_ERROR + '"}'
        else:
            if "loan" in t or "mortgage" in t or "help" in t:
                kind, extra = "assistance", ', "assistance_request": "general assistance"'
            elif any(w in t for w in ("lost", "fraud", "declined", "error", "hacked", "not")):
                kind, extra = "complaint", ""
            else:
                kind, extra = "inquiry", ""
            sev = "high" if "!" in t else "medium"
            body = ('{"ticket_type": "' + kind + '", "severity": "' + sev +
                    '", "preferred_communication": "email"' + extra + "}")
        return "[INST] prompt [/INST] " + body

    return lambda s: s.map(reply)


def domain_scores(df: DataFrame, keywords, text_col: str = "user_input", threshold: int = 1) -> DataFrame:
    """V4: number of the row's words found in ``keywords`` (an array column or
    scalar subquery; the keyword tables hold at most 10 words per class),
    in_domain = score >= threshold, and the ``error`` ticket of a rejected
    row (null for others)."""
    out = df.withColumn("_keywords", keywords)
    s = F.size(F.filter(ascii_words(text_col), lambda w: F.array_contains("_keywords", w)))
    out = out.withColumn("domain_score", s.cast("bigint")).drop("_keywords")
    return out.withColumn("in_domain", F.col("domain_score") >= threshold).withColumn(
        "error", F.when(F.col("domain_score") < threshold, F.lit(OUT_OF_DOMAIN_ERROR)))


def fit_classifier(train: DataFrame, text_col: str, label_col: str, max_fit_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """V2: multinomial naive Bayes over words, add-one smoothing, as two
    tables: ``(word, label, weight)`` = ln(count + 1), and per label its
    ``prior`` = ln(share of rows) and ``base`` = ln(words of the label +
    vocabulary size).  Vocabulary and labels come from ``train`` alone;
    ``max_fit_rows`` bounds the labelled rows that are counted (the first in
    the order of the input)."""
    rows = train.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("label"), F.col(text_col).alias("text"))
    if max_fit_rows is not None:
        rows = rows.limit(max_fit_rows)
    words = (rows.select("label", F.explode(ascii_words("text")).alias("word"))
             .groupBy("word", "label").agg(F.count("*").alias("n")).checkpoint(eager=True))
    size = words.agg(F.countDistinct("word")).scalar()
    per = rows.groupBy("label").agg(F.count("*").alias("n_rows"))
    labels = (per.join(words.groupBy("label").agg(F.sum("n").alias("n_words")), "label", "left")
              .select("label", F.log(F.col("n_rows") / per.agg(F.sum("n_rows")).scalar()).alias("prior"),
                      F.log(F.coalesce(F.col("n_words"), F.lit(0)) + size).alias("base")))
    return words.select("word", "label", F.log(F.col("n") + 1).alias("weight")), labels


def classify(model: tuple[DataFrame, DataFrame], rows: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id, pred_label``: the label with the largest log score (rounded to 9
    decimals, then the smallest label); words outside the vocabulary say
    nothing.  Words join the word table; no vocabulary is broadcast or
    collected."""
    words, labels = model
    bag = (rows.select(id_col, F.explode(ascii_words(text_col)).alias("word")).groupBy(id_col, "word").agg(F.count("*").alias("c")))
    known = words.groupBy("word").agg(F.collect_list(F.struct("label", "weight")).alias("by_label"))   # as many as labels
    bag = bag.join(known, "word")
    total = bag.groupBy(id_col).agg(F.sum("c").alias("k"))
    score = (bag.select(id_col, "c", F.explode("by_label").alias("x"))
             .groupBy(id_col, F.col("x.label").alias("label")).agg(F.sum(F.col("c") * F.col("x.weight")).alias("s"))
             .groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("label", "s"))).alias("s")))
    every = labels.agg(F.collect_list(F.struct("label", "prior", "base"))).scalar()
    out = rows.select(id_col).join(total, id_col, "left").join(score, id_col, "left").withColumn("labels", every)
    scored = F.transform("labels", lambda x: F.struct(
        (-F.round(x["prior"] + F.coalesce(F.try_element_at("s", x["label"]), F.lit(0.0))
                  - F.coalesce(F.col("k"), F.lit(0)) * x["base"], 9)).alias("score"), x["label"].alias("label")))
    return out.select(id_col, F.array_min(scored)["label"].alias("pred_label"))


# -- V2: TF-IDF and logistic regression ------------------------------------------

HASH_FEATURES = 1 << 16


def tf_idf(rows: DataFrame, text_col: str, id_col: str, min_rows: int = 1) -> DataFrame:
    """``(id, word, tf, df, tfidf)``: words of each row (T1) with the weight tf * ln((n + 1) / (df + 1)), n
    being the rows and df those with the word; words of fewer than ``min_rows`` rows are left out.
    Document frequencies are one aggregate; a common word's weight meets its rows by (word, salt)."""
    spread = F.pmod(F.xxhash64(id_col), F.lit(64))
    tf = (rows.select(id_col, F.explode(ascii_words(text_col)).alias("word")).groupBy(id_col, "word").agg(F.count("*").alias("tf"))
          .withColumn("_s", spread).checkpoint(eager=True))
    df = tf.groupBy("word").agg(F.count("*").alias("df")).where(F.col("df") >= min_rows)
    pairs = tf.select("word", "_s").distinct().join(df, "word")
    n = rows.agg(F.count("*")).scalar()
    return (tf.join(pairs, ["word", "_s"])
            .select(id_col, "word", "tf", "df", (F.col("tf") * F.log((n + 1) / (F.col("df") + 1))).alias("tfidf")))


def fit_logistic(train: DataFrame, text_col: str, label_col: str, features: int = HASH_FEATURES, regularisation: float = 0.01,
                 max_iter: int = 100, tolerance: float = 1e-6) -> PipelineModel:
    """V2: multinomial logistic regression over hashed TF-IDF features, fitted on the labelled rows of
    ``train`` until the objective changes by less than ``tolerance``.

    Words (T1) are hashed to ``features`` slots, so no vocabulary is gathered; what each fit step sends to
    the tasks is ``features`` x labels numbers, whatever the rows are.  Gradients are summed by trees of
    aggregates.  At least two labels are needed."""
    words = train.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("label_text"), F.coalesce(ascii_words(text_col), F.array()).alias("words"))
    words = words.checkpoint(eager=True)                 # each step goes over the rows again
    indexer = StringIndexer(inputCol="label_text", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error").fit(words)
    stages = [indexer, HashingTF(inputCol="words", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features"),
              LogisticRegression(featuresCol="features", labelCol="label", regParam=regularisation, maxIter=max_iter, tol=tolerance, family="multinomial"),
              IndexToString(inputCol="prediction", outputCol="pred_label", labels=indexer.labels)]
    return Pipeline(stages=stages).fit(words)


def classify_logistic(model: PipelineModel, rows: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id, pred_label`` of every row; a null or wordless text gets the label that the intercepts favour."""
    words = rows.select(id_col, F.coalesce(ascii_words(text_col), F.array()).alias("words"))
    steps = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])
    return steps.transform(words).select(id_col, "pred_label")


def label_mass(model: PipelineModel, rows: DataFrame, text_col: str) -> DataFrame:
    """``label, mass``: the probabilities that the rows' texts give each label, summed.  At the optimum of the
    fit, whose intercepts carry no penalty, a label's mass over the training rows is their number."""
    words = rows.select(F.coalesce(ascii_words(text_col), F.array()).alias("words"))
    steps = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])
    labels = model.stages[-1].getLabels()
    share = vector_to_array("probability")
    sums = steps.transform(words).agg(*(F.sum(F.get(share, F.lit(k))).alias(str(k)) for k in range(len(labels))))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(x).alias("label"), F.col(f"`{k}`").alias("mass")) for k, x in enumerate(labels)))))
