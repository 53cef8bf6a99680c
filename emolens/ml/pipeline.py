"""Fitted pipelines that are saved, reloaded and applied to raw rows.

Estimators learn from training rows, models hold what was learned as small
tables and turn any rows into long-form features ``(doc, feature, value)`` or
labels:

=================  =====================================================
`TextTfidf`        vocabulary with idf
`WholeOneHot`      category list, with the mode that fills gaps
`GenreTokens`      the words of a column (multi-hot)
`ScaledNumbers`    per column: median, fences, minimum, maximum
`SelectBest`       selected features with their chi² score and index
`Project`          (feature, component, weight), singular values, and mean
                   and population std per component
`NaiveBayes`       per class prior and length term, per feature log gains
`Linear`           per class bias, per feature weights (logistic, SVM)
`SparkModel`       a Spark ML model on dense components (trees, MLP)
=================  =====================================================

A `PipelineModel` is saved below one path: every table as Parquet, the
stages' parameters as rows of ``stages``.  Loading reads the tables back; a
reloaded pipeline scores raw rows by joins with them and needs neither the
training rows nor the session that fitted it.

Texts are features in blocks (`operators.term_blocks`), materialised once with
the vocabulary's terms; one (feature, class) aggregate of them serves chi² and Naive Bayes.
Tables that are broadcast have a bound by construction (one row per class,
per numeric column, per component, or at most ``k`` selected features).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emolens.ml.naive_bayes import NaiveBayesLong
from emolens.operators import features as X
from emolens.operators.describe import NUMERIC_FEATURES
from emolens.operators.quantiles import exact_mode
from emolens.operators.term_blocks import Features, TextBlocks, TextFeatures, vocabulary_rows
from emolens.session import cut_lineage

TOKEN_BLOCK, UNSEEN = "4:", "4"


@dataclass
class Model:
    """What an estimator learned: plain parameters and tables by name."""

    params: dict
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def save(self, path: str) -> None:
        for name, df in self.tables.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, params: dict, names: Sequence[str]) -> "Model":
        return cls(params, {n: spark.read.parquet(f"{path}/{n}") for n in names})


# ----------------------------------------------------------- feature blocks

class TextModel(Model):
    def transform(self, rows: DataFrame) -> TextFeatures:
        blocks = TextBlocks(rows, self.params["doc"], self.params["text"], tuple(self.params["ngram"]))
        return blocks.weigh(blocks.lookup(self.tables["vocabulary"]))


@dataclass(frozen=True)
class TextTfidf:
    doc: str
    text: str = "Description"
    ngram: tuple[int, int] = (1, 1)
    min_df: int = 2
    max_df: float = 0.95
    max_features: int | None = None

    def fit(self, rows: DataFrame) -> tuple[TextModel, TextFeatures]:
        """The model and the rows' features."""
        blocks = TextBlocks(rows, self.doc, self.text, self.ngram)
        weights = blocks.fit(float(rows.count()), self.min_df, self.max_df)
        vocab, only = vocabulary_rows(weights), None
        if self.max_features is not None:
            vocab = cut_lineage(X.most_frequent(vocab, self.max_features))
            only = [r["term"] for r in vocab.select("term").collect()]  # max_features rows
        return TextModel(asdict(self), {"vocabulary": vocab.select("term", "df", "idf")}), blocks.weigh(weights, only)


class OneHotModel(Model):
    def transform(self, rows: DataFrame) -> DataFrame:
        doc, column, mode = (self.params[k] for k in ("doc", "column", "mode"))
        filled = rows.select(doc, F.coalesce(F.col(column), F.lit(mode).cast("string")).alias("category"))
        return filled.join(self.tables["categories"], "category", "left_semi").select(
            doc, F.concat(F.lit(X.GENRE_BLOCK), "category").alias("feature"), F.lit(1.0).alias("value"))


@dataclass(frozen=True)
class WholeOneHot:
    doc: str
    column: str = "genres_text"

    def fit(self, rows: DataFrame) -> tuple[OneHotModel, DataFrame]:
        mode = exact_mode(rows, self.column)
        # a gap is filled by the mode, so it adds no category
        known = rows.where(F.col(self.column).isNotNull()).select(F.col(self.column).alias("category")).distinct()
        model = OneHotModel({**asdict(self), "mode": mode}, {"categories": cut_lineage(known)})
        return model, model.transform(rows)


class TokensModel(Model):
    def transform(self, rows: DataFrame) -> DataFrame:
        doc, column = self.params["doc"], self.params["column"]
        known = self.tables["tokens"].withColumn("known", F.lit(True))
        each = rows.select(doc, F.explode(F.array_distinct(_words(column))).alias("token")).join(known, "token", "left")
        if self.params["unseen"] == "ignore":
            each = each.where("known")
        name = F.when(F.col("known"), F.concat(F.lit(TOKEN_BLOCK), "token")).otherwise(F.lit(UNSEEN))
        return each.select(doc, name.alias("feature")).distinct().withColumn("value", F.lit(1.0))


@dataclass(frozen=True)
class GenreTokens:
    """Multi-hot of the words of a column.  Words in fewer than ``min_df``
    training rows and words never seen there are ``unseen``: 'ignore' drops
    them, 'mark' makes them one feature of their own."""

    doc: str
    column: str = "genres_text"
    min_df: int = 1
    unseen: str = "ignore"

    def fit(self, rows: DataFrame) -> tuple[TokensModel, DataFrame]:
        tokens = rows.select(F.explode(F.array_distinct(_words(self.column))).alias("token")).groupBy("token") \
            .agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= self.min_df)
        model = TokensModel(asdict(self), {"tokens": cut_lineage(tokens.select("token"))})
        return model, model.transform(rows)


def _words(column: str):
    return F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(r"(?U)\S+"), 0)


class NumbersModel(Model):
    def transform(self, rows: DataFrame) -> DataFrame:
        return X.scaled_numbers(rows, self.params["doc"], self.params["columns"], self.tables["columns"])


@dataclass(frozen=True)
class ScaledNumbers:
    doc: str
    columns: tuple[str, ...] = tuple(NUMERIC_FEATURES)
    factor: float = 1.5

    def fit(self, rows: DataFrame) -> tuple[NumbersModel, DataFrame]:
        table = cut_lineage(X.fit_numbers(rows, self.columns, self.factor))
        model = NumbersModel(asdict(self), {"columns": table})
        return model, model.transform(rows)


# ---------------------------------------------------- selection, projection

class SelectModel(Model):
    def transform(self, features: DataFrame | Features) -> DataFrame | Features:
        """Of features, or of rows with a ``feature``, the selected ones."""
        if isinstance(features, Features):
            return features.only(self.tables["selected"])
        return features.join(F.broadcast(self.tables["selected"].select("feature")), "feature", "left_semi")


@dataclass(frozen=True)
class SelectBest:
    k: int

    def fit(self, sums: DataFrame, priors: DataFrame) -> SelectModel:
        """From (feature, label, o) sums and (label, p) class shares."""
        best = X.select_k_best(X.chi2_from_sums(sums, priors, "label"), self.k)
        by_name = Window.orderBy("feature")  # k rows
        table = best.withColumn("index", (F.row_number().over(by_name) - 1).cast("int"))
        return SelectModel(asdict(self), {"selected": cut_lineage(table)})


class ProjectModel(Model):
    def transform(self, features: Features) -> DataFrame:
        """(doc, component, value) of documents with any known feature."""
        return self.arrays(features).select(self.params["doc"], F.posexplode("c").alias("component", "value"))

    def arrays(self, features: Features) -> DataFrame:
        """(doc, c): the components of each document as an array."""
        from emolens.ml.vectors import projected

        return projected(features, self.tables["weights"], self.params["doc"], self.params["components"])

    def vectors(self, features: Features, rows: DataFrame) -> DataFrame:
        """``rows`` with ``components``, scaled if the pipeline scales; a row
        without any known feature is projected to zero."""
        doc, k = self.params["doc"], self.params["components"]
        got = rows.join(self.arrays(features), doc, "left")
        c = F.coalesce("c", F.array_repeat(F.lit(0.0), k))
        if self.params["scale"]:
            moments = self.tables["scaling"].orderBy("component").collect()  # one row per component
            mean, std = (F.array(*[F.lit(r[x]) for r in moments]) for x in ("mean", "std"))
            c = F.zip_with(F.zip_with(c, mean, lambda a, m: a - m), std, lambda a, s: a / F.when(s == 0, 1.0).otherwise(s))
        return got.withColumn("components", c).drop("c")


@dataclass(frozen=True)
class Project:
    doc: str
    components: int = 100
    scale: bool = False

    def fit(self, features: Features, select: SelectModel, docs: DataFrame) -> ProjectModel:
        """``features`` of the training rows ``docs``, already selected."""
        from emolens.ml.vectors import svd_fit, to_sparse

        index = select.tables["selected"].select("feature", "index")
        size = index.count()
        v, s = svd_fit(to_sparse(features, index, docs.select(self.doc), self.doc, size), self.components)
        spark = docs.sparkSession
        # k x components numbers, as the fit leaves them; the sign of a
        # component is free: its largest weight is made positive
        sign = [1.0 if v[abs(v[:, j]).argmax(), j] >= 0 else -1.0 for j in range(v.shape[1])]
        local = spark.createDataFrame([(i, [float(x * g) for x, g in zip(v[i], sign, strict=True)]) for i in range(size)],
                                      "index int, w array<double>")
        weights = index.join(local, "index").select("feature", F.posexplode("w").alias("component", "weight"))
        model = ProjectModel(asdict(self), {
            "weights": cut_lineage(weights),
            "singular": spark.createDataFrame([(i, float(x)) for i, x in enumerate(s)], "component int, value double")})
        n = docs.count()
        sums = model.transform(features).groupBy("component").agg(F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q"))
        mean = F.col("s") / n
        model.tables["scaling"] = cut_lineage(sums.select(
            "component", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / n - mean * mean, F.lit(0.0))).alias("std")))
        return model


# --------------------------------------------------------------- classifiers

class BayesModel(Model):
    def predict(self, features: Features, rows: DataFrame, output: str) -> DataFrame:
        nb = NaiveBayesLong(self.params["classes"], self.tables["classes"], self.tables["gains"], "label")
        return nb.predict(features.long(), rows, self.params["doc"], output)


@dataclass(frozen=True)
class NaiveBayes:
    doc: str
    alpha: float = 1.0
    uniform_prior: bool = False

    def fit(self, sums: DataFrame, priors: DataFrame, classes: list[str], n_features: int) -> BayesModel:
        """From the (feature, label, o) sums of the selected features."""
        total = sums.groupBy("label").agg(F.sum("o").alias("t"))
        prior = F.lit(-math.log(len(classes))) if self.uniform_prior else F.log("p")
        table = priors.join(total, "label", "left").select(
            "label", prior.alias("prior"),
            (F.lit(math.log(self.alpha)) - F.log(F.coalesce("t", F.lit(0.0)) + self.alpha * n_features)).alias("a"))
        gains = sums.withColumn("g", F.log1p(F.col("o") / self.alpha)).groupBy("feature").pivot("label", classes).agg(F.first("g"))
        gains = gains.select("feature", *[F.col(f"`{c}`").alias(f"g_{i}") for i, c in enumerate(classes)])
        return BayesModel({**asdict(self), "classes": classes}, {"classes": cut_lineage(table), "gains": cut_lineage(gains)})


class LinearModel(Model):
    def predict(self, features: Features, rows: DataFrame, output: str) -> DataFrame:
        doc, classes = self.params["doc"], self.params["classes"]
        k = range(len(classes))
        # a row per selected feature: bounded
        sums = features.long().join(F.broadcast(self.tables["weights"]), "feature").groupBy(doc).agg(
            *[F.sum(F.col("value") * F.col("w")[i]).alias(f"_m{i}") for i in k])
        bias = {r["label"]: r["bias"] for r in self.tables["classes"].collect()}  # one row per class
        margin = F.array(*[F.lit(bias[c]) + F.coalesce(F.col(f"_m{i}"), F.lit(0.0)) for i, c in enumerate(classes)])
        best = F.element_at(F.array(*map(F.lit, classes)), F.array_position(margin, F.array_max(margin)).cast("int"))
        return rows.join(sums, doc, "left").withColumn(output, best).drop(*[f"_m{i}" for i in k])


@dataclass(frozen=True)
class Linear:
    """Logistic regression or a one-vs-rest SVM (`models.make_estimator`),
    kept as per-class weights."""

    doc: str
    family: str = "logistic"
    params: tuple[tuple[str, float], ...] = (("C", 1.0), ("max_iter", 3000))
    balanced: bool = True

    def fit(self, features: Features, select: SelectModel, docs: DataFrame, label: str, classes: list[str]) -> LinearModel:
        from emolens.ml.models import Candidate, make_estimator
        from emolens.ml.vectors import to_sparse

        index = select.tables["selected"].select("feature", "index")
        size = index.count()
        train = cut_lineage(to_sparse(features, index, _numbered(docs, self.doc, label, classes, self.balanced), self.doc, size))
        total = train.agg(F.sum("weight")).first()[0] or 1.0
        fitted = make_estimator(Candidate(self.family, dict(self.params)), size, len(classes), total).fit(train)
        if self.family == "logistic":
            rows, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
        else:
            rows, bias = [m.coefficients.toArray() for m in fitted.models], [m.intercept for m in fitted.models]
        spark = docs.sparkSession
        local = spark.createDataFrame([(i, [float(r[i]) for r in rows]) for i in range(size)], "index int, w array<double>")
        table = spark.createDataFrame([(c, float(b)) for c, b in zip(classes, bias, strict=True)], "label string, bias double")
        return LinearModel({"doc": self.doc, "classes": classes, "family": self.family},
                           {"weights": cut_lineage(index.join(local, "index").select("feature", "w")), "classes": table})


class SparkClassifier(Model):
    """A Spark ML model, saved by its own writer beside the tables."""

    fitted = None

    def predict(self, vectors: DataFrame, rows: DataFrame, output: str) -> DataFrame:
        names = F.array(*[F.lit(c) for c in self.params["classes"]])
        scored = self.fitted.transform(_as_vector(vectors))
        label = F.element_at(names, (F.col("prediction") + 1).cast("int"))
        return scored.withColumn(output, label).select(*rows.columns, output)

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(f"{path}/spark")

    @classmethod
    def load(cls, spark, path, params, names):
        from pyspark.ml import classification

        model = cls(params, {})
        model.fitted = getattr(classification, params["class"]).load(f"{path}/spark")
        return model


@dataclass(frozen=True)
class SparkModel:
    doc: str
    family: str = "decision_tree"
    params: tuple[tuple[str, object], ...] = ()
    balanced: bool = True

    def fit(self, vectors: DataFrame, label: str, classes: list[str]) -> SparkClassifier:
        from emolens.ml.models import Candidate, make_estimator

        train = cut_lineage(_as_vector(_numbered(vectors, self.doc, label, classes, self.balanced, ["components"])))
        size = len(train.select("components").first()[0])
        total = train.agg(F.sum("weight")).first()[0] or 1.0
        fitted = make_estimator(Candidate(self.family, dict(self.params)), size, len(classes), total).fit(train)
        model = SparkClassifier({"doc": self.doc, "classes": classes, "family": self.family, "class": type(fitted).__name__}, {})
        model.fitted = fitted
        return model


def _as_vector(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("features", array_to_vector("components"))


def _numbered(docs: DataFrame, doc: str, label: str, classes: list[str], balanced: bool, keep: Sequence[str] = ()) -> DataFrame:
    """(doc, keep..., label as number, weight)."""
    from emolens.operators.sampling import with_class_weights

    number = F.array_position(F.array(*map(F.lit, classes)), F.col("_label")) - 1
    rows = docs.select(doc, F.col(label).alias("_label"), *keep)
    return with_class_weights(rows, "_label", balanced=balanced).withColumn("label", number.cast("double")).drop("_label")


# ------------------------------------------------------------------ pipeline

_KINDS = {c.__name__: c for c in (TextModel, OneHotModel, TokensModel, NumbersModel, SelectModel, ProjectModel, BayesModel, LinearModel, SparkClassifier)}
_ROLES = ("text", "category", "numbers", "select", "project", "classifier")


@dataclass
class PipelineModel:
    """Fitted stages by role, in the order they are applied."""

    stages: dict[str, Model]

    def features(self, rows: DataFrame) -> DataFrame:
        """The selected long-form features of raw rows."""
        return self.selected(rows).long()

    def selected(self, rows: DataFrame) -> Features:
        """The selected features of raw rows."""
        text, category, numbers = (self.stages[r].transform(rows) for r in ("text", "category", "numbers"))
        return self.stages["select"].transform(Features(text, category.unionByName(numbers)))

    def vectors(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``components``; of a dense pipeline."""
        return self.stages["project"].vectors(self.selected(rows), rows)

    def transform(self, rows: DataFrame, output: str = "predicted") -> DataFrame:
        """``rows`` with a label each; needs the columns of the blocks and
        the document key, which tells the rows apart."""
        classifier = self.stages["classifier"]
        if isinstance(classifier, SparkClassifier):
            return classifier.predict(self.vectors(rows), rows, output)
        return classifier.predict(self.selected(rows), rows, output)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        for role, m in self.stages.items():
            m.save(f"{path}/{role}")
        rows = [(i, role, type(m).__name__, json.dumps(m.params), sorted(m.tables))
                for i, (role, m) in enumerate(self.stages.items())]
        spark.createDataFrame(rows, "position int, role string, kind string, params string, tables array<string>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/stages")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PipelineModel":
        rows = spark.read.parquet(f"{path}/stages").orderBy("position").collect()  # one row per stage
        return cls({r["role"]: _KINDS[r["kind"]].load(spark, f"{path}/{r['role']}", json.loads(r["params"]), r["tables"])
                    for r in rows})


@dataclass(frozen=True)
class Pipeline:
    """Text, category and number blocks, selection, and a classifier;
    with ``project``, the classifier works on components (dense), without on
    the selected features (sparse)."""

    text: TextTfidf
    category: WholeOneHot | GenreTokens
    numbers: ScaledNumbers
    select: SelectBest
    classifier: NaiveBayes | Linear | SparkModel
    project: Project | None = None

    @property
    def doc(self) -> str:
        return self.text.doc

    def fit(self, train: DataFrame, label: str) -> PipelineModel:
        doc = self.doc
        text, t = self.text.fit(train)
        category, c = self.category.fit(train)
        numbers, n = self.numbers.fit(train)
        labels = train.select(doc, F.col(label).alias("label"))
        whole = Features(t, cut_lineage(c.unionByName(n)))
        sums = cut_lineage(whole.sums(labels, "label"))
        total = float(train.count())
        priors = cut_lineage(labels.groupBy("label").agg((F.count(F.lit(1)) / F.lit(total)).alias("p")))
        classes = [r[0] for r in priors.orderBy("label").collect()]  # one row per class
        select = self.select.fit(sums, priors)
        stages: dict[str, Model] = {"text": text, "category": category, "numbers": numbers, "select": select}
        chosen = select.transform(whole)
        if isinstance(self.classifier, NaiveBayes):
            n_features = select.tables["selected"].count()
            stages["classifier"] = self.classifier.fit(select.transform(sums), priors, classes, n_features)
        elif isinstance(self.classifier, Linear):
            stages["classifier"] = self.classifier.fit(chosen, select, train, label, classes)
        else:
            stages["project"] = project = self.project.fit(chosen, select, train)
            vectors = project.vectors(chosen, train.select(doc, label))
            stages["classifier"] = self.classifier.fit(vectors, label, classes)
        return PipelineModel({r: stages[r] for r in _ROLES if r in stages})


def sparse_pipeline(doc: str, classifier: NaiveBayes | Linear, k: int = 1500, ngram: tuple[int, int] = (1, 1),
                    max_features: int | None = None) -> Pipeline:
    return Pipeline(TextTfidf(doc, ngram=ngram, max_features=max_features), WholeOneHot(doc), ScaledNumbers(doc),
                    SelectBest(k), classifier)


def dense_pipeline(doc: str, classifier: SparkModel, k: int = 1500, components: int = 100, scale: bool = False,
                   ngram: tuple[int, int] = (1, 2)) -> Pipeline:
    return Pipeline(TextTfidf(doc, ngram=ngram), WholeOneHot(doc), ScaledNumbers(doc), SelectBest(k), classifier,
                    Project(doc, components, scale))
