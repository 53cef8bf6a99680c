"""Oracle SQL for the modelling chain: split -> features -> chi² -> select
-> Naive Bayes.  Mirrors ``emolens.operators.sampling``/``features`` and
``emolens.ml.naive_bayes`` CTE by CTE."""

from __future__ import annotations

from emolens.operators.describe import NUMERIC_FEATURES
from emolens.plans.sqlparts import descriptions_ctes
from emolens.plans.q_terms import bigrams_sql, tokens_sql


def split_ctes(kind: str = "documents", seed: int = 42,
               test_size: float = 0.2, folds: int = 5, scored: str = "SELECT * FROM split WHERE split = 'test'") -> str:
    """Split and folds; ``scored`` gives the rows that a fitted model is
    applied to (the test rows, or others with the same columns)."""
    return descriptions_ctes(kind) + f""",
modelling AS (SELECT md5(Description) AS doc, * FROM descriptions
  QUALIFY count(*) OVER (PARTITION BY emotion) >= {folds}),
cls AS (SELECT emotion, count(*) AS n_class FROM modelling GROUP BY emotion),
tot AS (SELECT sum(n_class) AS n, CAST(ceil({test_size} * sum(n_class)) AS BIGINT) AS n_test FROM cls),
alloc AS (SELECT c.emotion, c.n_class, (c.n_class * (t.n - t.n_test)) // t.n AS base,
   (c.n_class * (t.n - t.n_test)) % t.n AS rem, t.n - t.n_test AS n_train FROM cls c, tot t),
left_over AS (SELECT any_value(n_train) - sum(base) AS lo FROM alloc),
alloc2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, emotion) AS pos FROM alloc),
quota AS (SELECT emotion, n_class - (base + CASE WHEN pos <= (SELECT lo FROM left_over) THEN 1 ELSE 0 END)
   AS test_quota FROM alloc2),
ranked AS (SELECT m.*, row_number() OVER (PARTITION BY emotion ORDER BY md5('{seed}:' || Description)) AS rk
   FROM modelling m),
split AS (SELECT r.*, CASE WHEN rk <= q.test_quota THEN 'test' ELSE 'train' END AS split,
   CASE WHEN rk <= q.test_quota THEN NULL ELSE CAST((rk - q.test_quota - 1) % {folds} AS INTEGER) END AS fold
   FROM ranked r JOIN quota q USING (emotion)),
train AS (SELECT * FROM split WHERE split = 'train'),
test AS ({scored})"""


def _grams(ngram) -> str:
    """N-grams of the token list ``t``."""
    if ngram == (1, 1):
        return "t"
    return bigrams_sql("t") if ngram == (2, 2) else f"list_concat(t, {bigrams_sql('t')})"


def text_ctes(ngram=(1, 1), min_df=2, max_df=0.95, max_features=None) -> str:
    g = _grams(ngram)
    cap = (f"ORDER BY cf DESC, term LIMIT {max_features}" if max_features else "")
    tokens = tokens_sql("coalesce(Description, 'missing_description')")
    return f""",
tok_train AS MATERIALIZED (SELECT doc, {tokens} AS t FROM train),
tok_test AS MATERIALIZED (SELECT doc, {tokens} AS t FROM test),
tf_train AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest({g}) AS term FROM tok_train) GROUP BY doc, term),
tf_test AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest({g}) AS term FROM tok_test) GROUP BY doc, term),
ntr AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM train),
vstat AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf_train GROUP BY term
   HAVING count(*) >= {min_df} AND count(*) <= {max_df} * (SELECT n FROM ntr) {cap}),
vocab AS (SELECT term, df, ln((1.0 + (SELECT n FROM ntr)) / (1.0 + df)) + 1.0 AS idf FROM vstat),
w_train AS (SELECT doc, term, (1.0 + ln(tf)) * idf AS w FROM tf_train JOIN vocab USING (term)),
w_test AS (SELECT doc, term, (1.0 + ln(tf)) * idf AS w FROM tf_test JOIN vocab USING (term)),
tfidf_train AS (SELECT doc, '0:' || term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS value FROM w_train),
tfidf_test AS (SELECT doc, '0:' || term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS value FROM w_test)"""


GENRE_CTES = """,
mode_g AS (SELECT genres_text AS g FROM train WHERE genres_text IS NOT NULL
   GROUP BY genres_text ORDER BY count(*) DESC, genres_text LIMIT 1),
cats AS (SELECT DISTINCT coalesce(genres_text, (SELECT g FROM mode_g)) AS c FROM train),
onehot_train AS (SELECT doc, '1:' || coalesce(genres_text, (SELECT g FROM mode_g)) AS feature, 1.0 AS value
   FROM train WHERE coalesce(genres_text, (SELECT g FROM mode_g)) IN (SELECT c FROM cats)),
onehot_test AS (SELECT doc, '1:' || coalesce(genres_text, (SELECT g FROM mode_g)) AS feature, 1.0 AS value
   FROM test WHERE coalesce(genres_text, (SELECT g FROM mode_g)) IN (SELECT c FROM cats))"""


def numeric_ctes(columns=NUMERIC_FEATURES, factor: float = 1.5) -> str:
    cols = list(columns)
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_med" for c in cols)
    imp = ", ".join(f"coalesce(CAST({c} AS DOUBLE), {c}_med) AS {c}" for c in cols)
    qq = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in cols)
    bnd = ", ".join(f"{c}_q1 - {factor} * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + {factor} * ({c}_q3 - {c}_q1) AS {c}_hi"
                    for c in cols)
    clip = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, {c}_hi), {c}_lo) END AS {c}"
                     for c in cols)
    mm = ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in cols)

    def scaled(src):
        parts = []
        for c in cols:
            v = f"greatest(least(coalesce(CAST({src}.{c} AS DOUBLE), {c}_med), {c}_hi), {c}_lo)"
            parts.append(f"({v} - {c}_min) / CASE WHEN {c}_max = {c}_min THEN 1.0 ELSE {c}_max - {c}_min END AS {c}")
        return ", ".join(parts)

    def long(src):
        return " UNION ALL ".join(
            f"SELECT doc, '2:{i}:{c}' AS feature, {c} AS value FROM {src} WHERE {c} IS NOT NULL AND {c} <> 0"
            for i, c in enumerate(cols))

    return f""",
med AS (SELECT {med} FROM train),
imp_tr AS (SELECT doc, {imp} FROM train, med),
qq AS (SELECT {qq} FROM imp_tr),
bnd AS (SELECT {bnd} FROM qq),
clip_tr AS (SELECT doc, {clip} FROM imp_tr, bnd),
mm AS (SELECT {mm} FROM clip_tr),
numx_train AS (SELECT train.doc, {scaled('train')} FROM train, med, bnd, mm),
numx_test AS (SELECT test.doc, {scaled('test')} FROM test, med, bnd, mm),
num_train AS ({long('numx_train')}),
num_test AS ({long('numx_test')})"""


def features_ctes(ngram=(1, 1), **kw) -> str:
    return text_ctes(ngram, **kw) + GENRE_CTES + numeric_ctes() + """,
feat_train AS (SELECT * FROM tfidf_train UNION ALL SELECT * FROM onehot_train UNION ALL SELECT * FROM num_train),
feat_test AS (SELECT * FROM tfidf_test UNION ALL SELECT * FROM onehot_test UNION ALL SELECT * FROM num_test)"""


def chi2_ctes(k: int) -> str:
    return f""",
lab AS (SELECT doc, emotion FROM train),
prior_p AS (SELECT emotion, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM train) AS p FROM train GROUP BY emotion),
obs AS (SELECT feature, emotion, sum(value) AS o FROM feat_train JOIN lab USING (doc) GROUP BY feature, emotion),
tt AS (SELECT feature, sum(o) AS t FROM obs GROUP BY feature),
chi2 AS (SELECT feature, sum(o * o / (p * t)) - any_value(t) AS chi2
   FROM obs JOIN prior_p USING (emotion) JOIN tt USING (feature) GROUP BY feature),
sel AS (SELECT feature, chi2, row_number() OVER (ORDER BY round(chi2, 9) DESC, feature DESC) AS position
   FROM chi2 QUALIFY position <= {k})"""


def nb_ctes(alpha: float, uniform_prior: bool) -> str:
    prior = "-ln((SELECT count(*) FROM classes))" if uniform_prior else \
        "ln(c.n_c / (SELECT CAST(count(*) AS DOUBLE) FROM train))"
    return f""",
fsel_train AS (SELECT f.* FROM feat_train f JOIN sel USING (feature)),
fsel_test AS (SELECT f.* FROM feat_test f JOIN sel USING (feature)),
fc AS (SELECT feature, emotion, sum(value) AS fc FROM fsel_train JOIN lab USING (doc) GROUP BY feature, emotion),
nfeat AS (SELECT count(DISTINCT feature) AS nf FROM fsel_train),
classes AS (SELECT emotion, count(*) AS n_c FROM train GROUP BY emotion),
ct AS (SELECT c.emotion, {prior} AS prior,
   ln({alpha}) - ln(coalesce(t.t, 0) + {alpha} * (SELECT nf FROM nfeat)) AS a
   FROM classes c LEFT JOIN (SELECT emotion, sum(fc) AS t FROM fc GROUP BY emotion) t USING (emotion)),
gw AS (SELECT feature, emotion, ln(1 + fc / {alpha}) AS g FROM fc),
sx AS (SELECT doc, sum(value) AS s FROM fsel_test GROUP BY doc),
cx AS (SELECT x.doc, gw.emotion, sum(x.value * gw.g) AS c FROM fsel_test x JOIN gw USING (feature)
   GROUP BY x.doc, gw.emotion),
jll AS (SELECT t.doc, t.Description, t.emotion AS actual, ct.emotion AS cls,
   ct.prior + coalesce(sx.s, 0) * ct.a + coalesce(cx.c, 0) AS jll
   FROM test t CROSS JOIN ct LEFT JOIN sx ON sx.doc = t.doc
   LEFT JOIN cx ON cx.doc = t.doc AND cx.emotion = ct.emotion),
pred AS (SELECT doc, Description, actual, cls AS predicted FROM jll
   QUALIFY row_number() OVER (PARTITION BY doc ORDER BY jll DESC, cls) = 1)"""


def grid_sql(grid, folds: int = 5, columns=NUMERIC_FEATURES, factor: float = 1.5) -> str:
    """The Naive Bayes grid: every statistic grouped by ``held``, the fold
    left out; one row per candidate with its parameters and scores."""
    long = " UNION ALL ".join(f"SELECT doc, fold, {i} AS pos, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM train"
                              for i, c in enumerate(columns))
    cands = ", ".join(f"({c['candidate_id']}, {c['alpha']}, {str(c['fit_prior']).lower()}, {c['ngram']}, {c['k']})" for c in grid.candidates())
    values = lambda xs: ", ".join(f"({x})" for x in xs)
    scaled = "greatest(least(coalesce(v, med), hi), lo)"
    each = [(k, a, f"c{i}") for i, (k, a) in enumerate((k, a) for k in grid.ks for a in grid.alphas)]
    wide = ", ".join(f"coalesce(sum(f.value * ln(1 + g.o / {a})) FILTER (WHERE g.position <= {k}), 0) AS {c}" for k, a, c in each)
    pairs = " UNION ALL ".join(f"SELECT held, ngram, doc, cls, {k} AS k, {a} AS alpha, {c} AS c FROM cw" for k, a, c in each)
    # read many times below
    split = split_ctes(folds=folds).replace("\nsplit AS (", "\nsplit AS MATERIALIZED (")
    return "WITH " + split + f""",
fs AS (SELECT unnest(range({folds})) AS held), gs(ngram) AS (VALUES {values(grid.ngrams)}), ks(k) AS (VALUES {values(grid.ks)}),
als(alpha) AS (VALUES {values(grid.alphas)}), cand(candidate_id, alpha, fit_prior, ngram, k) AS (VALUES {cands}),
tk AS MATERIALIZED (SELECT doc, fold, {tokens_sql("coalesce(Description, 'missing_description')")} AS t FROM train),
tf AS MATERIALIZED (SELECT doc, fold, term, count(*) AS tf FROM (
  SELECT doc, fold, unnest({_grams((1, max(grid.ngrams)))}) AS term FROM tk) GROUP BY ALL),
nh AS (SELECT held, count(*) AS n FROM train JOIN fs ON fold <> held GROUP BY held),
voc AS MATERIALIZED (SELECT held, term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 AS idf FROM tf JOIN fs ON fold <> held JOIN nh USING (held)
  GROUP BY held, term, n HAVING count(*) >= 2 AND count(*) <= 0.95 * n),
w AS (SELECT held, ngram, doc, term, (1.0 + ln(tf)) * idf AS w FROM tf JOIN voc USING (term) JOIN gs ON ngram >= len(string_split(term, ' '))),
tx AS (SELECT held, ngram, doc, '0:' || term AS feature, w / sqrt(sum(w * w) OVER (PARTITION BY held, ngram, doc)) AS value FROM w),
seen AS (SELECT held, genres_text AS c, count(*) AS n FROM train JOIN fs ON fold <> held WHERE genres_text IS NOT NULL GROUP BY ALL),
mo AS (SELECT held, c AS m FROM seen QUALIFY row_number() OVER (PARTITION BY held ORDER BY n DESC, c) = 1),
oh AS (SELECT seen.held, doc, '1:' || seen.c AS feature, 1.0 AS value
  FROM train CROSS JOIN mo JOIN seen ON seen.held = mo.held AND seen.c = coalesce(genres_text, m)),
num AS ({long}),
md AS (SELECT held, col, quantile_cont(v, 0.5) AS med FROM num JOIN fs ON fold <> held GROUP BY ALL),
qs AS (SELECT held, col, med, quantile_cont(coalesce(v, med), 0.25) AS q1, quantile_cont(coalesce(v, med), 0.75) AS q3
  FROM num JOIN md USING (col) WHERE fold <> held GROUP BY ALL),
fe AS (SELECT held, col, med, q1 - {factor} * (q3 - q1) AS lo, q3 + {factor} * (q3 - q1) AS hi FROM qs),
mm AS (SELECT held, col, med, lo, hi, min({scaled}) AS a, max({scaled}) AS b FROM num JOIN fe USING (col) WHERE fold <> held GROUP BY ALL),
nb AS (SELECT held, doc, '2:' || pos || ':' || col AS feature, ({scaled} - a) / CASE WHEN b = a THEN 1.0 ELSE b - a END AS value
  FROM num JOIN mm USING (col)),
feat AS MATERIALIZED (SELECT * FROM tx UNION ALL SELECT held, ngram, doc, feature, value FROM
  (SELECT * FROM oh UNION ALL SELECT * FROM nb WHERE value IS NOT NULL AND value <> 0) CROSS JOIN gs),
sums AS MATERIALIZED (SELECT held, ngram, feature, emotion, sum(value) AS o FROM feat JOIN train USING (doc) WHERE fold <> held GROUP BY ALL),
pri AS (SELECT held, emotion, count(*) / CAST(n AS DOUBLE) AS p FROM train JOIN fs ON fold <> held JOIN nh USING (held) GROUP BY held, emotion, n),
tt AS (SELECT held, ngram, feature, sum(o) AS t FROM sums GROUP BY ALL),
chi AS (SELECT held, ngram, feature, sum(o * o / (p * t)) - any_value(t) AS chi2 FROM sums JOIN pri USING (held, emotion)
  JOIN tt USING (held, ngram, feature) GROUP BY ALL),
best AS MATERIALIZED (SELECT held, ngram, feature, row_number() OVER (PARTITION BY held, ngram ORDER BY round(chi2, 9) DESC, feature DESC) AS position
  FROM chi QUALIFY position <= {max(grid.ks)}),
gains AS MATERIALIZED (SELECT * FROM sums JOIN best USING (held, ngram, feature)),
nf AS (SELECT held, ngram, k, count(*) AS nf FROM best JOIN ks ON position <= k GROUP BY ALL),
ft AS (SELECT held, ngram, k, emotion, sum(o) AS t FROM gains JOIN ks ON position <= k GROUP BY ALL),
ct AS MATERIALIZED (SELECT c.*, nf.held, pri.emotion AS cls, CASE WHEN fit_prior THEN ln(p) ELSE -ln((SELECT count(DISTINCT emotion) FROM train)) END AS prior,
  ln(alpha) - ln(coalesce(t, 0) + alpha * nf) AS a
  FROM cand c JOIN nf USING (ngram, k) JOIN pri USING (held)
  LEFT JOIN ft ON ft.held = nf.held AND ft.ngram = c.ngram AND ft.k = c.k AND ft.emotion = pri.emotion),
sx AS (SELECT held, ngram, doc, k, sum(value) AS s FROM feat JOIN best USING (held, ngram, feature) JOIN ks ON position <= k GROUP BY ALL),
cw AS MATERIALIZED (SELECT f.held, f.ngram, f.doc, g.emotion AS cls, {wide}
  FROM feat f JOIN gains g ON g.held = f.held AND g.ngram = f.ngram AND g.feature = f.feature GROUP BY f.held, f.ngram, f.doc, g.emotion),
cx AS ({pairs}),
jll AS (SELECT ct.candidate_id, ct.held, train.doc, train.fold = ct.held AS val, train.emotion AS actual, ct.cls,
  prior + coalesce(s, 0) * a + coalesce(c, 0) AS jll
  FROM train CROSS JOIN ct LEFT JOIN sx ON sx.held = ct.held AND sx.ngram = ct.ngram AND sx.doc = train.doc AND sx.k = ct.k
  LEFT JOIN cx ON cx.held = ct.held AND cx.ngram = ct.ngram AND cx.doc = train.doc AND cx.k = ct.k AND cx.alpha = ct.alpha AND cx.cls = ct.cls),
pred AS (SELECT candidate_id, held, val, actual, cls AS predicted FROM jll
  QUALIFY row_number() OVER (PARTITION BY candidate_id, held, doc ORDER BY jll DESC, cls) = 1),
lc AS (SELECT candidate_id, held, val, label, sum(s) AS s, sum(tp) AS tp, sum(pc) AS pc FROM (
  SELECT candidate_id, held, val, actual AS label, 1 AS s, CAST(actual = predicted AS INT) AS tp, 0 AS pc FROM pred
  UNION ALL SELECT candidate_id, held, val, predicted, 0, 0, 1 FROM pred) GROUP BY ALL),
f1 AS (SELECT candidate_id, held, val, avg(CASE WHEN s + pc = 0 THEN 0.0 ELSE 2.0 * tp / (s + pc) END) AS f1 FROM lc GROUP BY ALL),
sc AS (SELECT candidate_id, avg(f1) FILTER (WHERE NOT val) AS mean_train_score, avg(f1) FILTER (WHERE val) AS mean_test_score,
  stddev_pop(f1) FILTER (WHERE val) AS std_test_score FROM f1 GROUP BY candidate_id)"""
