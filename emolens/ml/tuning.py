"""Grid search with feature reuse per fold.

The source refits the whole preprocessing for every candidate x fold.  Here
the long-form features are built once per (fold, n-gram range) and the chi²
selection once per (fold, n-gram, k); every model parameter reuses them.
Feature tables are checkpointed (reliable, shared folder) so a lost executor
does not replay the featurisation.  Fold scores come back as a DataFrame and
``evaluate.model_comparison`` ranks the candidates.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emolens.ml.models import Candidate, fit_predict
from emolens.ml.vectors import feature_index, to_sparse
from emolens.operators import evaluate as E
from emolens.operators import features as X
from emolens.operators.sampling import with_class_weights
from emolens.session import cut_lineage


def vector_sets(train: DataFrame, others: dict[str, DataFrame], doc: str, label: str,
                classes: list[str], k: int, ngram=(1, 1), balanced: bool = False):
    """Fit features on ``train`` and return vectors for train and others."""
    names = list(others)
    f_tr, f_ot = X.assemble_long(train, _union(others, doc), doc, ngram=ngram)
    sc = X.chi2_scores(f_tr, train.select(doc, label), doc, label)
    sel = X.select_k_best(sc, k).select("feature")
    idx = cut_lineage(feature_index(sel))
    size = idx.count()
    lab = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    tr = with_class_weights(train.select(doc, label), label, balanced=balanced)
    tr = tr.withColumns({"label": lab.cast("double"), "actual": F.col(label)})
    vtr = to_sparse(f_tr, idx, tr, doc, size)
    out = {}
    for n in names:
        d = others[n].select(doc, F.col(label).alias("actual"))
        out[n] = to_sparse(f_ot, idx, d, doc, size)
    return vtr, out


def _union(others: dict[str, DataFrame], doc: str) -> DataFrame:
    dfs = list(others.values())
    u = dfs[0]
    for d in dfs[1:]:
        u = u.unionByName(d)
    return u.dropDuplicates([doc])


def grid_search(train: DataFrame, doc: str, label: str, candidates: list[Candidate],
                folds: int = 5, fold_col: str = "fold") -> DataFrame:
    """Fold scores for every candidate: (model, candidate_id, fold,
    macro_f1 on the held-out fold, train_macro_f1 on the fold's training part)."""
    classes = [r[0] for r in train.select(label).distinct().orderBy(label).collect()]
    groups = defaultdict(list)
    for i, c in enumerate(candidates):
        p = c.params
        groups[(tuple(p.get("ngram", (1, 1))), int(p.get("k", 1000)), bool(p.get("balanced")))].append((i, c))
    results = []
    for f in range(folds):
        tr_f = train.where(F.col(fold_col) != f)
        va_f = train.where(F.col(fold_col) == f)
        for (ngram, k, balanced), cands in groups.items():
            vtr, vo = vector_sets(tr_f, {"val": va_f}, doc, label, classes, k, ngram, balanced)
            vtr = cut_lineage(vtr)
            for i, c in cands:
                _, preds = fit_predict(c, vtr, {"train": vtr, "val": vo["val"]}, classes)
                for part, p in preds.items():
                    results.append(p.select(F.lit(c.name).alias("model"), F.lit(i).alias("candidate_id"),
                                            F.lit(f).alias("fold"), F.lit(part).alias("part"),
                                            "actual", "predicted"))
    allp = results[0]
    for r in results[1:]:
        allp = allp.unionByName(r)
    allp = cut_lineage(allp)
    s = E.summary_metrics(E.label_counts(allp, by=("model", "candidate_id", "fold", "part")),
                          ("model", "candidate_id", "fold", "part"))
    val = s.where(F.col("part") == "val").select("model", "candidate_id", "fold", "macro_f1")
    trn = s.where(F.col("part") == "train").select("model", "candidate_id", "fold",
                                                   F.col("macro_f1").alias("train_macro_f1"))
    return val.join(trn, ["model", "candidate_id", "fold"])
