"""Toxicity by a chain of linear models: each category sees the probabilities before it.

Features are the words of a text and their first four letters, present or not, as 64-bit
hashes. The models of a category are fitted in folds, so that the next category learns
from probabilities of texts that the earlier model has not seen, as it will meet them.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import checkpointed, claim, ship

# Categories in the order of the chain, each a condition on the labels table.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
# Steps of Newton's method, and of conjugate gradients within each.
NEWTON, GRADIENTS = 12, 15


@dataclass
class Model:
    """Weights of known features and of earlier probabilities; a constant has none."""

    name: str
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probability(self, values: np.ndarray, starts: np.ndarray, before: np.ndarray):
        """Of each text: its features are values[starts[i]:starts[i + 1]]."""
        score = np.full(len(starts) - 1, self.intercept)
        if len(self.features) and len(values):
            at = np.minimum(np.searchsorted(self.features, values), len(self.features) - 1)
            own = np.where(self.features[at] == values, self.weights[at], 0.0)
            total = np.concatenate([[0.0], np.cumsum(own)])
            score += total[starts[1:]] - total[starts[:-1]]
        if len(self.earlier):
            score += before @ self.earlier
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


def features(text: Column) -> Column:
    """Hashes of a text's distinct lower-case words and of the starts of longer ones."""
    words = F.filter(
        F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]++")),
        lambda w: w != "",
    )
    starts = F.transform(
        F.filter(words, lambda w: F.length(w) > 4),
        lambda w: F.xxhash64(F.lit("start"), F.substring(w, 1, 4)),
    )
    return F.concat(F.transform(words, lambda w: F.xxhash64(w)), F.array_distinct(starts))


def fit(
    documents: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES,
    sample_rows: int = 12_000, folds: int = 4, least_texts: int = 4, evidence: float = 15.0,
    penalty: float = 0.0001,
) -> list[Model]:
    """The chain, fitted on at most `sample_rows` labelled documents.

    The sample is the labelled ids of the smallest hash. A document labelled twice belongs
    to a category if one of its labels does; NULL labels count as no, NULL ids are left
    out, NULL text as empty, and repeated documents count once. A feature must occur in
    `least_texts` of a fit's texts and differ between the category and the rest by a
    chi-square of `evidence`. Without labelled documents every probability is 0; where all
    are alike, it is that of the sample.
    """
    ship(documents.sparkSession)
    marked = labels.select(
        F.col("doc_id").alias("id"),
        *[F.coalesce(F.expr(c).cast("double"), F.lit(0.0)).alias(n) for n, c in categories.items()],
    ).filter("id IS NOT NULL")
    chosen = (
        marked.groupBy("id").agg(*[F.max(name).alias(name) for name in categories])
        .orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    sample = checkpointed(
        documents.select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
        .join(F.broadcast(chosen), "id")  # sample_rows at most
        .groupBy("id", *categories).agg(F.min("t").alias("t"))
        .select("id", *categories, features(F.col("t")).alias("f"))
        .withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)))
        .withColumn("before", F.array().cast("array<double>"))
    )
    chain: list[Model] = []
    for name in categories:
        last = len(chain) == len(categories) - 1
        # run r leaves fold r out; the last run takes all and gives the model
        runs = [folds] if last else range(folds + 1)
        fitted = checkpointed(
            sample.select(
                "id", "f", "before", "fold", F.col(name).alias("label"),
                F.explode(F.array(*map(F.lit, runs))).alias("run"),
            )
            .groupBy("run")
            .applyInPandas(
                _fitter(folds, least_texts, evidence, penalty, len(chain)),
                "id BIGINT, p DOUBLE, feature BIGINT, weight DOUBLE, place INT",
            )
        )
        chain.append(_model(name, fitted, len(chain)))
        if not last:
            unseen = fitted.filter("id IS NOT NULL").select("id", "p")
            sample = checkpointed(
                sample.join(unseen, "id")
                .withColumn("before", F.concat("before", F.array("p")))
                .drop("p")
            )
    return chain


def _model(name: str, fitted: DataFrame, earlier: int) -> Model:
    """The weights, which the words of a bounded sample bound."""
    # apart, since a column with NULL would come as floating point and lose digits
    known = fitted.filter("feature IS NOT NULL").select("feature", "weight").toPandas()
    known = known.sort_values("feature")
    extra = fitted.filter("place IS NOT NULL").select("place", "weight").toPandas()
    extra = dict(zip(extra["place"].tolist(), extra["weight"].tolist()))
    return Model(
        name,
        known["feature"].to_numpy(dtype=np.int64),
        known["weight"].to_numpy(dtype=np.float64),
        np.array([extra.get(i, 0.0) for i in range(earlier)]),
        float(extra.get(-1, -500.0)),
    )


def _fitter(
    folds: int, least_texts: int, evidence: float, penalty: float, earlier: int
) -> Callable:
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        claim("toxicity")
        group = group.sort_values("id")
        left_out = (group["fold"] == key[0]).to_numpy()
        learnt, rest = group[~left_out], group[left_out]
        model = _learn(learnt, least_texts, evidence, penalty, earlier)
        if key[0] < folds:
            values, starts, before = _arrays(rest, earlier)
            p = model.probability(values, starts, before)
            found = pd.DataFrame({"id": rest["id"].to_numpy(), "p": p})
        else:
            places = [-1, *range(earlier)]
            found = pd.concat(
                [
                    pd.DataFrame(
                        {"feature": pd.array(model.features, "Int64"), "weight": model.weights}
                    ),
                    pd.DataFrame(
                        {"weight": [model.intercept, *model.earlier][: len(places)],
                         "place": places[: 1 + len(model.earlier)]}
                    ),
                ]
            )
        kinds = {"id": "Int64", "p": "Float64", "feature": "Int64", "weight": "Float64", "place": "Int32"}
        return found.reindex(columns=list(kinds)).astype(kinds)

    return run


def _arrays(rows: pd.DataFrame, earlier: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(f) for f in rows["f"]]
    values = np.concatenate([*rows["f"], np.empty(0, np.int64)]).astype(np.int64)
    before = np.array([list(b) for b in rows["before"]], np.float64).reshape(len(rows), earlier)
    return values, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), before


def _learn(
    rows: pd.DataFrame, least_texts: int, evidence: float, penalty: float, earlier: int
) -> Model:
    """Logistic regression with a penalty on squared weights, by Newton's method."""
    values, starts, before = _arrays(rows, earlier)
    labels = rows["label"].to_numpy(dtype=np.float64)
    none = Model("", np.empty(0, np.int64), np.empty(0), np.empty(0), -500.0)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        none.intercept = 500.0 if share else -500.0
        return none
    known, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), np.diff(starts))
    n = len(rows)
    expected = counts * share
    met = np.bincount(column, labels[row], minlength=len(known))
    usable = (counts >= least_texts) & (counts < n)
    usable &= (met - expected) ** 2 >= evidence * expected * (1 - share)
    place = np.cumsum(usable) - 1
    use = usable[column]
    row, column, known = row[use], place[column[use]], known[usable]
    size = len(known)

    def times(w: np.ndarray) -> np.ndarray:
        sparse = np.bincount(row, w[column], minlength=n) if size else np.zeros(n)
        return sparse + before @ w[size:-1] + w[-1]

    def back(r: np.ndarray) -> np.ndarray:
        sparse = np.bincount(column, r[row], minlength=size) if size else np.empty(0)
        return np.concatenate([sparse, r @ before, [r.sum()]])

    ridge = np.full(size + earlier + 1, penalty)
    ridge[-1] = 1e-9
    w = np.zeros(size + earlier + 1)
    w[-1] = np.log(share / (1 - share))
    for _ in range(NEWTON):
        p = 1 / (1 + np.exp(-np.clip(times(w), -500, 500)))
        slope = back(p - labels) / n + ridge * w
        if np.abs(slope).max() < 1e-6:
            break
        curve = np.maximum(p * (1 - p), 1e-6)
        w -= _solved(lambda v: back(curve * times(v)) / n + ridge * v, slope)
    return Model("", known, w[:size], w[size:-1], float(w[-1]))


def _solved(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray) -> np.ndarray:
    """A few steps of conjugate gradients towards times(x) = right."""
    x = np.zeros_like(right)
    rest = right.copy()
    step, size = rest.copy(), rest @ rest
    goal = size * 1e-6
    for _ in range(GRADIENTS):
        image = times(step)
        far = size / (step @ image)
        x += far * step
        rest -= far * image
        before, size = size, rest @ rest
        if size <= goal:
            break
        step = rest + size / before * step
    return x


def probabilities(spark, chain: list[Model]) -> Callable[[Column], Column]:
    """A column function from a text to a struct of its categories' probabilities."""
    ship(spark)
    sent = spark.sparkContext.broadcast(chain)  # as large as the words of the sample

    def score(rows: pd.Series) -> pd.DataFrame:
        claim("toxicity")
        starts = np.concatenate([[0], np.cumsum([len(f) for f in rows])]).astype(np.int64)
        values = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        found: dict[str, np.ndarray] = {}
        for model in sent.value:
            before = np.array(list(found.values())).T.reshape(len(rows), len(found))
            found[model.name] = model.probability(values, starts, before)
        return pd.DataFrame(found)

    kind = ", ".join(f"`{model.name}` DOUBLE" for model in chain)
    scored = F.pandas_udf(score, kind)
    return lambda text: scored(features(text))


def score(documents: DataFrame, chain: list[Model], text: str = "text") -> DataFrame:
    """`document` (a struct of all given columns) and `p` (a struct by category).

    Every row keeps its columns, whatever their names; NULL and empty texts get the
    probabilities of a text without words; repeated rows get equal ones. An empty table
    gives an empty one.
    """
    p = probabilities(documents.sparkSession, chain)
    return documents.select(F.struct("*").alias("document")).select(
        "document", p(F.col("document")[text]).alias("p")
    )
