"""Queries: labelled sets, statistics, sampling, models, evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import bindings as B
from cohortry.catalog import panels as P
from cohortry.catalog import tables as C
from cohortry.catalog.bindings import with_
from cohortry.catalog.registry import query
from cohortry.functions.quantiles import quantiles
from cohortry.functions.scale import discard, materialized, noted
from cohortry.operators import cleaning, evaluate, labels, models, neighbours, outliers, sampling, stats
from cohortry.plans import features, propensity

DIMS = [f"e{i}" for i in range(64)]
# The parameters that the reference's grids name, each with the one value of the models' specs.
GRID = ("learning_rate", "n_estimators", "positive_weight", "subsample", "max_depth", "min_rows_per_leaf", "column_share", "min_gain")


# -- inputs ------------------------------------------------------------------------

def vectors(spark, sf_dir):
    """vec_id, 64 feature columns, target (label 0, about one row in ten)."""
    return B.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(DIMS)],
        (F.col("label") == 0).cast("int").alias("target"),
        "label",
    )


VECTORS = """
long AS (
  SELECT vec_id, label, (label = 0)::BIGINT AS target, unnest(range(64)) AS dim,
    unnest(embedding)::DOUBLE AS x FROM embeddings)"""

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def lines(spark, sf_dir):
    return B.table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, *LINE_COLUMNS, (F.col("l_returnflag") == "R").cast("int").alias("target")
    )


LINES = "lines AS (SELECT *, (l_returnflag = 'R')::BIGINT AS target FROM lineitem)"
LONG_LINES = LINES + ", long AS (" + " UNION ALL ".join(
    f"SELECT target, '{c}' AS feature, {c} AS x FROM lines" for c in LINE_COLUMNS
) + ")"


def urgent_orders(spark, sf_dir):
    return B.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("target"),
    )


ORDERS = "ord AS (SELECT o_orderkey, o_totalprice, (o_orderpriority = '1-URGENT')::BIGINT AS target FROM orders)"


def document_scores(spark, sf_dir):
    """Labelled documents with a score made from their length."""
    docs, marks = B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "labels")
    score = F.least(F.col("n_chars"), F.lit(8000)) / F.lit(8000.0)
    return docs.join(marks, "doc_id").select(
        "doc_id", F.col("quality").alias("target"), score.alias("probability")
    )


SCORES = """
scores AS (
  SELECT doc_id, quality::BIGINT AS target, least(n_chars, 8000) / 8000.0 AS probability
  FROM documents JOIN labels USING (doc_id)),
scored AS (SELECT *, (probability >= 0.5)::BIGINT AS predicted FROM scores)"""


# -- labelled sets --------------------------------------------------------------------

_AT = "CAST(make_date(((s.m + 1) // 12)::INT, ((s.m + 1) % 12 + 1)::INT, 1) AS TIMESTAMP)"
_B2G = specs.CHANNEL_FLAGS["b2g"]

LABEL_INPUTS = [B.TX, B.EVENTS, B.REGISTRY, B.PREPARED, *C.lifecycle_ctes("ev", "reg"), B.roles("ctx")]

# The compared columns of both panels, whose rows are the same: of a row's own month, and of its trailing three.
LABEL_ROWS = f"""
months AS (SELECT DISTINCT p AS m FROM ctx),
spine AS (
  SELECT company, m, ids.xin_value AS party FROM (SELECT company, min(p) AS first FROM ev GROUP BY company) f
  JOIN months ON first <= m LEFT JOIN ids ON ids.company_id = company WHERE company IN (SELECT company FROM cohort)),
own AS (
  SELECT party, p, count(*) FILTER (plan = 0) AS plan_0, count(*) FILTER (plan = 1) AS plan_1, count(*) FILTER (plan = 2) AS plan_2,
    count(*) FILTER (role = 'sent') AS sent, max(cents) FILTER (role = 'sent') / 100.0 AS top
  FROM roles GROUP BY ALL),
latest AS (
  SELECT party, m, sum(plan_1)::BIGINT AS plan_1, sum(plan_2)::BIGINT AS plan_2, sum(sent)::BIGINT AS sent, max(top) AS top,
    median(sent) FILTER (sent > 0) AS med
  FROM own JOIN months ON p <= m AND p > m - 3 GROUP BY ALL),
channels AS (SELECT party, role, p, channel, count(*) AS n FROM roles WHERE channel IS NOT NULL GROUP BY ALL),
chan AS (
  SELECT party, m, role, channel
  FROM (SELECT party, m, role, channel, sum(n) AS n FROM channels JOIN months ON p <= m AND p > m - 3 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY party, m, role ORDER BY n DESC, channel) = 1),
b2g AS (SELECT party, m, count(*) AS flag FROM chan WHERE channel = '{_B2G}' GROUP BY ALL),
met AS (
  SELECT party, partner, 1 AS half, min(p) AS p FROM roles WHERE role = 'sent' AND is_sent AND partner IS NOT NULL GROUP BY ALL
  UNION ALL SELECT party, partner, 2, min(p) FROM roles WHERE role = 'sent' AND is_rec AND partner IS NOT NULL GROUP BY ALL),
receivers AS (SELECT party, m, count(*) AS n FROM met JOIN months ON p <= m GROUP BY ALL),
listed AS (SELECT party, min(p) AS p FROM roles WHERE (role = 'sent' AND is_sent) OR (role = 'rec' AND is_rec) GROUP BY party),
label_rows AS (
  SELECT s.company, s.party AS xin_value, strftime({_AT} - INTERVAL 1 DAY, '%Y%m') AS timestamp_ym,
    CASE WHEN l.p <= s.m THEN coalesce(r.n, 0) ELSE 0 END AS num_receivers,
    coalesce(t.plan_1, 0) AS plan_1, coalesce(t.plan_2, 0) AS plan_2, coalesce(t.sent, 0) AS trans_sum_sent, coalesce(t.med, 0) AS med,
    coalesce(t.top, 0) AS top, coalesce(g.flag, 0) AS flag, coalesce(o.plan_0, 0) AS own_0, coalesce(o.plan_1, 0) AS own_1,
    coalesce(o.plan_2, 0) AS own_2, coalesce(o.sent, 0) AS own_sent, ma.active_prem,
    {B.day_diff(_AT, 'alta_basic')} AS days_since_alta_basic, {B.day_diff(_AT, 'alta_premium')} AS days_since_alta_premium,
    {B.day_diff(_AT, 'ended')} AS days_since_baixa_prem
  FROM spine s LEFT JOIN listed l ON l.party = s.party LEFT JOIN receivers r ON r.party = s.party AND r.m = s.m
  LEFT JOIN latest t ON t.party = s.party AND t.m = s.m LEFT JOIN own o ON o.party = s.party AND o.p = s.m
  LEFT JOIN b2g g ON g.party = s.party AND g.m = s.m
  LEFT JOIN master ma ON ma.company = s.company LEFT JOIN churn c ON c.company = s.company),
joined AS (
  SELECT *, (sum(own_0) {P.OVER})::BIGINT AS acum_0, (sum(own_1) {P.OVER})::BIGINT AS acum_1, (sum(own_2) {P.OVER})::BIGINT AS acum_2,
    (sum(own_sent) {P.OVER})::BIGINT AS sum_trans_sent, round(median(med) {P.OVER}, 6) AS med_trans_sent_m,
    max(top) {P.OVER} AS max_import_sent, (sum(flag) {P.OVER})::BIGINT AS b2g_acum
  FROM label_rows)"""

LAST = """(row_number() OVER (PARTITION BY company ORDER BY timestamp_ym DESC, coalesce(xin_value, '') DESC) = 1)::BIGINT"""

CHURN_ROWS = LABEL_ROWS + f""",
labelled AS (
  SELECT *, {LAST} AS target FROM joined
  WHERE company IN (SELECT company FROM churn) AND (days_since_baixa_prem < 0 OR days_since_baixa_prem IS NULL)
  UNION ALL SELECT *, 0 FROM joined WHERE active_prem = 1 AND company NOT IN (SELECT company FROM churn))"""

UPSELL_ROWS = LABEL_ROWS + f""",
labelled AS (
  SELECT *, {LAST} AS target FROM joined
  WHERE active_prem = 1 AND plan_1 = 0 AND (days_since_alta_premium < 0 OR days_since_alta_premium IS NULL)
  UNION ALL SELECT *, 0 FROM joined WHERE active_prem IS NULL AND company IN (SELECT company FROM master)
    AND company NOT IN (SELECT company FROM churn_basic) AND days_since_alta_premium IS NULL)"""

CHECKED = "num_receivers, trans_sum_sent, med_trans_sent_m, max_import_sent, b2g_acum"


# What the compared columns of the labelled sets are made of.
SET_INPUT = (
    "company", "xin_value", "timestamp_ym", "days_since_alta_basic", "days_since_alta_premium", "days_since_baixa_prem",
    "plan_1", "plan_2", *labels.LIFETIME, *[c.strip() for c in CHECKED.split(",")],
)


def training_sets(spark, sf_dir, names=("churn", "upsell"), columns=None):
    """The labelled sets of these names, from one panel of which the rows they take are stored, or these columns of them.
    What the panel alone was made of is deleted then."""
    p = C.prepared(spark, sf_dir)
    with noted() as made:
        t = features.build_training_tables(p, P.TRAILING, medians=columns is None)
        panel = t.behaviour.select(*columns) if columns else t.behaviour
        rows = materialized(labels.training_rows(panel, t.companies, t.churn, t.churn_basic, names))
    discard(p.tx, p.ids, *[table for table in made if table is not rows])
    sets = {
        "churn": lambda: labels.churn_training_set(rows, None, t.companies, t.churn),
        "upsell": lambda: labels.upsell_training_set(rows, None, t.companies, t.churn_basic),
    }
    return {name: sets[name]() for name in names}


@query("churn_training_set", with_(*LABEL_INPUTS, CHURN_ROWS) + f"""
SELECT x.company, x.xin_value, x.timestamp_ym, x.company || '-' || x.timestamp_ym AS company_new, x.target,
  CASE WHEN x.days_since_alta_basic < 180 THEN 0 ELSE ceil(x.days_since_alta_basic / 365.0) END AS ant,
  x.plan_1 + x.plan_2 AS plan_1, x.acum_0, x.acum_1 + x.acum_2 AS acum_1, x.sum_trans_sent,
  {', '.join('x.' + c.strip() for c in CHECKED.split(','))}
FROM labelled x""", ("ant", "acum_0", "acum_1", "sum_trans_sent"))
def churn_training_set(spark, sf_dir):
    return training_sets(spark, sf_dir, ("churn",), SET_INPUT)["churn"].select(
        "company", "xin_value", "timestamp_ym", "company_new", "target", "ant", "plan_1", "acum_0",
        "acum_1", "sum_trans_sent", *[c.strip() for c in CHECKED.split(",")],
    )


@query("upsell_training_set", with_(*LABEL_INPUTS, UPSELL_ROWS) + f"""
SELECT x.company, x.xin_value, x.timestamp_ym, x.company || '-' || x.timestamp_ym AS company_new, x.target,
  x.acum_0, x.acum_1, x.sum_trans_sent, {', '.join('x.' + c.strip() for c in CHECKED.split(','))}
FROM labelled x""", ("acum_0", "acum_1", "sum_trans_sent"))
def upsell_training_set(spark, sf_dir):
    return training_sets(spark, sf_dir, ("upsell",), SET_INPUT)["upsell"].select(
        "company", "xin_value", "timestamp_ym", "company_new", "target", "acum_0", "acum_1",
        "sum_trans_sent", *[c.strip() for c in CHECKED.split(",")],
    )


# -- statistics -----------------------------------------------------------------------

@query("standardize", with_(VECTORS) + """,
fit AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s FROM long WHERE target = 0 GROUP BY 1)
SELECT vec_id, 'e' || dim AS feature, round((x - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS value
FROM long JOIN fit USING (dim)""")
def standardize(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    _, scaled = stats.standardize(rows.filter("target = 0"), rows, DIMS)
    return stats.unpivot(scaled, ["vec_id"], DIMS)


@query("random_probe", """
SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || '|1'), 1, 15))::BIGINT % 1000 AS random FROM orders""")
def random_probe(spark, sf_dir):
    return sampling.random_probe(B.table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


IQR_REACH = 0.2


@query("iqr_outliers", with_(LONG_LINES) + f""",
q AS (SELECT feature, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM long GROUP BY 1)
SELECT {', '.join(LINE_KEY + LINE_COLUMNS)}, target FROM lines WHERE """ + " AND ".join(
    f"{c} BETWEEN (SELECT a - {IQR_REACH} * (b - a) FROM q WHERE feature = '{c}') AND (SELECT b + {IQR_REACH} * (b - a) FROM q WHERE feature = '{c}')"
    for c in LINE_COLUMNS))
def iqr_outliers(spark, sf_dir):
    return outliers.iqr_outliers(lines(spark, sf_dir), LINE_COLUMNS, IQR_REACH)


def _sequential_sql() -> str:
    steps, last = [LINES], "lines"
    for i, c in enumerate(LINE_COLUMNS):
        steps.append(f"""
q{i} AS (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM {last}),
s{i} AS (SELECT {last}.* FROM {last}, q{i} WHERE {c} BETWEEN a - {IQR_REACH} * (b - a) AND b + {IQR_REACH} * (b - a))""")
        last = f"s{i}"
    return with_(*steps) + f"SELECT {', '.join(LINE_KEY + LINE_COLUMNS)}, target FROM {last}"


@query("iqr_outliers_sequential", _sequential_sql())
def iqr_outliers_sequential(spark, sf_dir):
    return outliers.iqr_outliers(lines(spark, sf_dir), LINE_COLUMNS, IQR_REACH, sequential=True)


@query("isolation_outliers")
def isolation_outliers(spark, sf_dir):
    rows = vectors(spark, sf_dir).drop("label")
    return outliers.isolation_outliers(rows, ["vec_id"], DIMS).select("vec_id", "target")


@query("isolation_cut", with_(SCORES) + """
SELECT doc_id, target, probability FROM scores
WHERE target = 1 OR probability <= (SELECT quantile_cont(probability, 0.85) FROM scores WHERE target = 0)""")
def isolation_cut(spark, sf_dir):
    """The cut step of the isolation filter, on given scores: the most isolated 15 % of class 0 go."""
    scores = document_scores(spark, sf_dir)
    kept = outliers.without_highest(scores.filter("target = 0"), "probability", 0.15)
    return kept.unionByName(scores.filter("target = 1"))


@query("correlation_matrix", with_(VECTORS) + """
SELECT 'e' || a.dim AS i, 'e' || b.dim AS j, round(corr(a.x, b.x), 6) + 0.0 AS r
FROM long a JOIN long b USING (vec_id) GROUP BY ALL""")
def correlation_matrix(spark, sf_dir):
    return stats.correlation_matrix(vectors(spark, sf_dir), DIMS)


@query("describe_by_class", with_(LONG_LINES) + """
SELECT target, feature, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min,
  round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
  round(quantile_cont(x, 0.75), 6) AS q75, max(x) AS max FROM long GROUP BY ALL""")
def describe_by_class(spark, sf_dir):
    return stats.describe_by_class(lines(spark, sf_dir), LINE_COLUMNS)


@query("histogram_by_class", with_(LINES) + """
SELECT target, floor(log10(l_extendedprice) / 0.05)::BIGINT AS bin, count(*) AS n
FROM lines WHERE l_extendedprice > 0 GROUP BY ALL""")
def histogram_by_class(spark, sf_dir):
    return stats.histogram_by_class(lines(spark, sf_dir), "l_extendedprice", 0.05, log=True)


@query("boxplot_stats", with_(LONG_LINES) + """,
q AS (SELECT target, feature, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50,
        quantile_cont(x, 0.75) AS q75 FROM long GROUP BY ALL)
SELECT target, feature, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
  min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS n_outside
FROM (SELECT *, x >= q25 - 1.5 * (q75 - q25) AND x <= q75 + 1.5 * (q75 - q25) AS inside FROM long JOIN q USING (target, feature))
GROUP BY target, feature, q25, q50, q75""")
def boxplot_stats(spark, sf_dir):
    return stats.boxplot_stats(lines(spark, sf_dir), LINE_COLUMNS)


@query("class_counts", with_(ORDERS) + "SELECT target, count(*) AS n FROM ord GROUP BY 1")
def class_counts(spark, sf_dir):
    return stats.class_counts(urgent_orders(spark, sf_dir))


# -- sampling ----------------------------------------------------------------------------

def _hash(seed: int) -> str:
    return f"md5(o_orderkey || '|{seed}')"


@query("upsample_minority", with_(ORDERS) + f""",
n AS (SELECT count(*) FILTER (target = 0) AS zeros, count(*) FILTER (target = 1) AS ones FROM ord),
ranked AS (SELECT *, row_number() OVER (ORDER BY {_hash(123)}, o_orderkey) AS k FROM ord WHERE target = 1),
draws AS (SELECT ('0x' || substr(md5(id || '|123'), 1, 15))::BIGINT % ones + 1 AS k
  FROM (SELECT unnest(range(zeros)) AS id, ones FROM n))
SELECT o_orderkey, o_totalprice, target FROM ord WHERE target = 0
UNION ALL SELECT o_orderkey, o_totalprice, target FROM draws JOIN ranked USING (k)""")
def upsample_minority(spark, sf_dir):
    return sampling.upsample_minority(urgent_orders(spark, sf_dir), ["o_orderkey"])


def _split_sql(whole: bool) -> str:
    test = "floor(floor(n1 * 0.25) * 3)" if whole else "floor(n1 * 0.25 * 3)"
    train = "floor(floor(n1 * 0.75) * 3)" if whole else "floor(n1 * 0.75 * 3)"
    return with_(ORDERS) + f""",
cleaned AS (SELECT * FROM ord WHERE o_totalprice < 480000),
n AS (SELECT count(*) AS n1 FROM cleaned WHERE target = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {_hash(1)}) AS k FROM cleaned),
train_zeros AS (SELECT ranked.* FROM ranked, n WHERE target = 0 AND k <= {train}),
test_zeros AS (
  SELECT o_orderkey FROM (
    SELECT *, row_number() OVER (ORDER BY {_hash(2)}) AS j FROM ord
    WHERE target = 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM train_zeros)), n WHERE j <= {test})
SELECT o_orderkey, 1::BIGINT AS target, CASE WHEN k <= floor(n1 * 0.75) THEN 'train' ELSE 'test' END AS part
FROM ranked, n WHERE target = 1
UNION ALL SELECT o_orderkey, 0, 'train' FROM train_zeros UNION ALL SELECT o_orderkey, 0, 'test' FROM test_zeros"""


def _split(spark, sf_dir, spec):
    rows = urgent_orders(spark, sf_dir)
    parts = sampling.ratio_split(rows.filter("o_totalprice < 480000"), rows, ["o_orderkey"], spec)
    return parts.select("o_orderkey", "target", "part")


@query("ratio_split", _split_sql(True))
def ratio_split(spark, sf_dir):
    return _split(spark, sf_dir, specs.CHURN_SPLIT)


@query("ratio_split_upsell", _split_sql(False))
def ratio_split_upsell(spark, sf_dir):
    return _split(spark, sf_dir, specs.UPSELL_SPLIT)


@query("nearest_neighbours", with_(VECTORS) + """,
ones AS (SELECT * FROM long WHERE target = 1),
d AS (SELECT a.vec_id, b.vec_id AS neighbour, sqrt(sum((a.x - b.x) * (a.x - b.x))) AS distance
  FROM ones a JOIN ones b ON a.dim = b.dim AND a.vec_id <> b.vec_id GROUP BY ALL)
SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS nth, neighbour,
  round(distance, 6) AS distance FROM d
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) <= 5""")
def nearest_neighbours(spark, sf_dir):
    rows = vectors(spark, sf_dir).filter("target = 1")
    return neighbours.nearest_neighbours(rows, "vec_id", DIMS)


def _lot(key: str, seed: int) -> str:
    return f"('0x' || substr(md5({key} || '|{seed}'), 1, 15))::BIGINT"


@query("smote", f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, (label = 0)::BIGINT AS target FROM embeddings),
ones AS (SELECT *, row_number() OVER (ORDER BY md5(vec_id || '|1'), vec_id) AS rank FROM v WHERE target = 1),
sizes AS (SELECT count(*) FILTER (target = 0) AS n0, count(*) FILTER (target = 1) AS n1 FROM v),
near AS (
  SELECT a.vec_id, b.vec_id AS neighbour, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS nth
  FROM ones a JOIN ones b ON a.vec_id <> b.vec_id),
draws AS (
  SELECT {_lot('id', 1)} % n1 + 1 AS rank, {_lot('id', 2)} % least(5, n1 - 1) + 1 AS nth, {_lot('id', 3)}::DOUBLE / 1152921504606846976.0 AS place
  FROM (SELECT unnest(range(greatest(n0 - n1, 0))) AS id, n1 FROM sizes) WHERE n1 > 1),
made AS (
  SELECT list_transform(range(1, 65), lambda i: a.e[i] + place * (b.e[i] - a.e[i])) AS e
  FROM draws JOIN ones a USING (rank) JOIN near ON near.vec_id = a.vec_id AND near.nth = draws.nth JOIN ones b ON b.vec_id = near.neighbour)
SELECT vec_id, {', '.join(f'round(e[{i + 1}], 6) + 0.0 AS e{i}' for i in range(64))}, target FROM v
UNION ALL SELECT NULL, {', '.join(f'round(e[{i + 1}], 6) + 0.0' for i in range(64))}, 1 FROM made""", ("vec_id",))
def smote(spark, sf_dir):
    return neighbours.smote(vectors(spark, sf_dir).drop("label"), "vec_id", DIMS)


# -- models --------------------------------------------------------------------------------

MODELS = {"churn": propensity.CHURN_MODEL, "upsell": propensity.UPSELL_MODEL}


def _ready(rows, model: propensity.ModelSpec) -> propensity.Prepared:
    return propensity.prepare(materialized(propensity.model_matrix(rows, model)), model)


def _one_ready(spark, sf_dir, name: str) -> propensity.Prepared:
    return _ready(training_sets(spark, sf_dir, (name,))[name], MODELS[name])


@query("boosted_classifier")
def boosted_classifier(spark, sf_dir):
    """The churn model end to end: features, labels, outliers, scaling,
    split, fit, scores of the test part."""
    ready = _one_ready(spark, sf_dir, "churn")
    scored, _ = propensity.fit_and_score(ready, propensity.CHURN_MODEL)
    return scored


@query("upsell_classifier")
def upsell_classifier(spark, sf_dir):
    ready = _one_ready(spark, sf_dir, "upsell")
    scored, _ = propensity.fit_and_score(ready, propensity.UPSELL_MODEL)
    return scored


def _both_models(spark, sf_dir):
    """Name, spec, prepared rows and the parts of their split, of each model; both come from one panel, side by side."""
    def one(name, rows):
        def job():
            model = MODELS[name]
            ready = _ready(rows, model)
            parts = materialized(sampling.ratio_split(ready.train, ready.everything, [propensity.KEY], model.split))
            return name, model, ready, parts

        return job

    return models.side_by_side(spark, [one(*x) for x in training_sets(spark, sf_dir).items()])


def _united(spark, models_, table):
    """The table of each model, made side by side, with the model's name."""
    def one(name, model, ready, parts):
        return lambda: table(model, ready, parts).select(F.lit(name).alias("model"), "*")

    return reduce(lambda a, b: a.unionByName(b), models.side_by_side(spark, [one(*m) for m in models_]))


@query("grid_search")
def grid_search(spark, sf_dir):
    """Each combination of the models' grids with its AUC, on the training part."""
    lines_ = []
    for name, model, ready, parts in _both_models(spark, sf_dir):
        grid = {k: [getattr(model.trees, k)] for k in GRID}
        found = models.search_trees(parts.filter("part = 'train'"), ready.features, model.trees, grid)
        lines_ += [(name, *(float(getattr(trees, k)) for k in GRID), auc) for trees, auc in found]
    return spark.createDataFrame(lines_, "model string, " + ", ".join(f"{k} double" for k in GRID) + ", auc double")


@query("halving_search")
def halving_search(spark, sf_dir):
    """A grid of several values for the churn model, by successive halving, with its full number of trees."""
    model = propensity.CHURN_MODEL
    ready = _one_ready(spark, sf_dir, "churn")
    parts = sampling.ratio_split(ready.train, ready.everything, [propensity.KEY], model.split)
    grid = {"learning_rate": [model.trees.learning_rate, 0.1], "max_depth": [model.trees.max_depth, 3]}
    tried = models.halving_search(parts.filter("part = 'train'"), [propensity.KEY], ready.features, model.trees, grid)
    lines_ = [(k, share, *(float(getattr(trees, name)) for name in grid), auc) for k, share, trees, auc in tried]
    return spark.createDataFrame(lines_, "round int, share double, " + ", ".join(f"{name} double" for name in grid) + ", auc double")


@query("kfold_auc")
def kfold_auc(spark, sf_dir):
    return _united(spark, _both_models(spark, sf_dir), lambda model, ready, parts: models.kfold_auc(
        parts.filter("part = 'train'").drop("part"), ready.features, [propensity.KEY], model.trees
    ))


@query("full_coverage_scoring", """
SELECT vec_id, ('0x' || substr(md5(vec_id || '|1'), 1, 15))::BIGINT % 4 AS fold, (label = 0)::BIGINT AS target, true AS scored
FROM embeddings""")
def full_coverage_scoring(spark, sf_dir):
    """Each row once, with the fold whose model hasn't seen it; that it has a probability stands for the score."""
    scores = models.out_of_fold_scores(vectors(spark, sf_dir), DIMS, ["vec_id"], specs.CHURN_TREES)
    return scores.select("vec_id", "fold", "target", F.col("probability").between(0, 1).alias("scored"))


FOLDED = with_(SCORES) + """,
folded AS (SELECT *, ('0x' || substr(md5(doc_id || '|1'), 1, 15))::BIGINT % 5 AS fold FROM scores),
ranked AS (SELECT fold, target, rank() OVER w + (count(*) OVER (PARTITION BY fold, probability) - 1) / 2.0 AS r
  FROM folded WINDOW w AS (PARTITION BY fold ORDER BY probability)),
aucs AS (SELECT fold, (sum(r) FILTER (target = 1) - count(*) FILTER (target = 1) * (count(*) FILTER (target = 1) + 1) / 2.0)
    / nullif(count(*) FILTER (target = 1) * count(*) FILTER (target = 0), 0) AS auc FROM ranked GROUP BY fold)
"""


@query("fold_auc_summary", FOLDED + """
SELECT round(avg(auc), 6) AS mean, round(stddev_pop(auc), 6) AS std, round(min(auc), 6) AS min, round(max(auc), 6) AS max,
  count(auc) AS folds FROM aucs""")
def fold_auc_summary(spark, sf_dir):
    """The summary of a cross-validation, on given scores."""
    scores = document_scores(spark, sf_dir).withColumn("fold", sampling.fold_of(["doc_id"], 5, 1))
    return models.summarize_folds(scores)


@query("rank_given_importance", with_(VECTORS) + """
SELECT 'e' || dim AS feature, round(avg(x), 6) + 0.0 AS coefficient,
  CASE WHEN avg(x) < 0 THEN 'negative' ELSE 'positive' END AS sign FROM long GROUP BY dim""")
def rank_given_importance(spark, sf_dir):
    """Ranking of weights that are given: the columns' means."""
    long = stats.unpivot(vectors(spark, sf_dir), [], DIMS)
    return evaluate.rank_importance(long.groupBy("feature").agg(F.avg("value").alias("coefficient")))


@query("correlation_with_missing", """
WITH lines AS (SELECT CASE WHEN l_linenumber % 3 > 0 THEN l_quantity END AS a, l_extendedprice AS b,
  CASE WHEN l_orderkey % 4 > 0 THEN l_discount END AS c FROM lineitem),
cells AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc FROM lines)
SELECT i, j, round(r, 6) + 0.0 AS r FROM (
  SELECT unnest(['a','a','a','b','b','b','c','c','c']) AS i, unnest(['a','b','c','a','b','c','a','b','c']) AS j,
    unnest([1.0, ab, ac, ab, 1.0, bc, ac, bc, 1.0]) AS r FROM cells)""")
def correlation_with_missing(spark, sf_dir):
    """Each pair over the rows that have both values."""
    rows = B.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity")).alias("a"), F.col("l_extendedprice").alias("b"),
        F.when(F.col("l_orderkey") % 4 > 0, F.col("l_discount")).alias("c"),
    )
    return stats.correlation_matrix(rows, ["a", "b", "c"])


@query("param_sweep")
def param_sweep(spark, sf_dir):
    return _united(spark, _both_models(spark, sf_dir), lambda model, ready, parts: models.param_sweep(
        parts.filter("part = 'train'"), parts.filter("part = 'test'"), ready.features, model.trees,
        "learning_rate", [0.01, 0.05, 0.1, 0.2, 0.3],
    ))


@query("mlp_classifier")
def mlp_classifier(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    return models.score(models.mlp_classifier(rows, DIMS), rows, DIMS, ["vec_id"])


@query("rank_importance")
def rank_importance(spark, sf_dir):
    return _united(spark, _both_models(spark, sf_dir), lambda model, ready, parts: evaluate.rank_importance(
        models.feature_importance(
            models.fit_boosted(parts.filter("part = 'train'"), ready.features, model.trees), ready.features, ready.train
        )
    ))


@query("positional_merge", with_(VECTORS) + """
SELECT dim AS position, round(avg(x), 6) + 0.0 AS left_value, 'e' || dim AS right_value FROM long GROUP BY dim""")
def positional_merge(spark, sf_dir):
    """Column names and column means of the vectors, paired by position."""
    rows = vectors(spark, sf_dir)
    means = rows.agg(F.array(*[F.avg(c) for c in DIMS]).alias("values"))
    names = rows.agg(F.array(*[F.max(F.lit(c)) for c in DIMS]).alias("values"))
    return evaluate.positional_merge(means, names)


# -- evaluation ------------------------------------------------------------------------------

@query("probability_filter", with_(SCORES) + """
SELECT doc_id || '-2022' AS company_new, round(probability, 6) AS probability FROM scores WHERE probability < 0.2""")
def probability_filter(spark, sf_dir):
    keyed = document_scores(spark, sf_dir).select(
        F.concat_ws("-", "doc_id", F.lit("2022")).alias("company_new"), "probability"
    )
    return cleaning.improbable(keyed, "company_new", "probability", 0.2, "-2022")


@query("rank_scores", with_(SCORES) + """
SELECT doc_id, target, round(probability, 6) AS probability FROM scores WHERE target = 0
ORDER BY probability DESC, doc_id""")
def rank_scores(spark, sf_dir):
    return evaluate.rank_scores(document_scores(spark, sf_dir), ["doc_id"])


@query("threshold_predict", with_(SCORES) + "SELECT doc_id, target, round(probability, 6) AS probability, predicted FROM scored")
def threshold_predict(spark, sf_dir):
    return evaluate.threshold_predict(document_scores(spark, sf_dir))


ROC = with_(SCORES) + """,
counts AS (SELECT probability, count(*) FILTER (target = 1) AS pos, count(*) FILTER (target = 0) AS neg FROM scores GROUP BY 1),
curve AS (
  SELECT probability AS threshold, pos, neg, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp,
    (sum(pos) OVER ())::BIGINT AS positives, (sum(neg) OVER ())::BIGINT AS negatives
  FROM counts WINDOW w AS (ORDER BY probability DESC))
"""


@query("roc_points", ROC + """
SELECT round(threshold, 6) AS threshold, pos, neg, tp, fp, positives, negatives,
  round(tp / positives, 6) AS tpr, round(fp / negatives, 6) AS fpr FROM curve""")
def roc_points(spark, sf_dir):
    return evaluate.roc_points(document_scores(spark, sf_dir))


@query("roc_auc", ROC + "SELECT round(sum(neg * (2 * tp - pos)) / (2.0 * max(positives) * max(negatives)), 6) AS auc FROM curve")
def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(document_scores(spark, sf_dir))


@query("classification_report", with_(SCORES) + """,
c AS (
  SELECT label, count(*) FILTER (target = label AND predicted = label) AS hit,
    count(*) FILTER (predicted = label) AS guessed, count(*) FILTER (target = label) AS support
  FROM scored, (VALUES (0), (1)) v(label) GROUP BY 1),
l AS (
  SELECT label::VARCHAR AS label, CASE WHEN guessed = 0 THEN 0.0 ELSE hit / guessed END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS recall,
    CASE WHEN guessed + support = 0 THEN 0.0 ELSE 2.0 * hit / (guessed + support) END AS f1, support FROM c),
a AS (SELECT avg((target = predicted)::INT) AS acc FROM scored),
r AS (
  SELECT * FROM l
  UNION ALL SELECT 'accuracy', acc, acc, acc, (SELECT sum(support) FROM l) FROM a
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM l
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM l)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM r""")
def classification_report(spark, sf_dir):
    return evaluate.classification_report(evaluate.threshold_predict(document_scores(spark, sf_dir)))


@query("confusion_partitions", with_(SCORES) + """
SELECT doc_id, target, round(probability, 6) AS probability, predicted,
  CASE WHEN target = predicted THEN 'T' ELSE 'F' END || CASE WHEN predicted = 1 THEN 'P' ELSE 'N' END AS outcome FROM scored""")
def confusion_partitions(spark, sf_dir):
    return evaluate.confusion_partitions(evaluate.threshold_predict(document_scores(spark, sf_dir)))


@query("confusion_matrix", with_(SCORES) + "SELECT target, predicted, count(*) AS n FROM scored GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(evaluate.threshold_predict(document_scores(spark, sf_dir)))


@query("score_distribution", with_(SCORES) + """,
span AS (SELECT predicted, min(probability) AS low, max(probability) AS high FROM scored GROUP BY 1)
SELECT predicted AS predicted_class,
  CASE WHEN high > low THEN least(floor((probability - low) / (high - low) * 30), 29) ELSE 0 END::BIGINT AS bin,
  round(low, 6) AS low, round(high, 6) AS high, count(*) AS n
FROM scored JOIN span USING (predicted) GROUP BY ALL""")
def score_distribution(spark, sf_dir):
    return evaluate.score_distribution(evaluate.threshold_predict(document_scores(spark, sf_dir)))


@query("exact_quantiles", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS q10,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.99), 6) AS q99
FROM lineitem GROUP BY 1""")
def exact_quantiles(spark, sf_dir):
    """Quantiles by narrowing, the way groups too large for a task get them."""
    rows = B.table(spark, sf_dir, "lineitem")
    probs = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    return quantiles(rows, ["l_returnflag"], "l_extendedprice", probs, hot_rows=1000)
