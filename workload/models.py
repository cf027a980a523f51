"""Queries on statistics, curves, the model, its registry, scoring and streams."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators import evaluate, model, profile, quality, ranks, registry, scoring, stats
from ledgerlight.plans import features as feat
from ledgerlight.session import materialise
from ledgerlight.sources import tables
from ledgerlight.streaming import scored_stream as stream
from workload.cleaned import features, scratch
from workload.registry import VIEWS, query, r, rs, tidy
from workload.tables import bank, given

STUDIED = feat.STUDIED_NUMERIC
TESTED = (*feat.STUDIED_CATEGORICAL, *feat.STUDIED_BINARY)
RUN_AT = datetime(2026, 1, 1)


# --- statistics --------------------------------------------------------------

@query(
    "label_correlations",
    " union all ".join(f"select '{c}' as variable, {r(f'corr({c}, fraud_flag)', 'correlation')} from feature_rows" for c in STUDIED),
)
def label_correlations(spark, sf):
    return tidy(stats.label_correlations(features(spark, sf), STUDIED, "fraud_flag"))


PAIRED = feat.NUMERIC


@query(
    "correlation_pairs",
    " union all ".join(
        f"select '{a}' as variable_1, '{b}' as variable_2, {r(f'corr({a}, {b})', 'correlation')} from feature_rows"
        for i, a in enumerate(PAIRED) for b in PAIRED[i + 1:]
    ),
)
def correlation_pairs(spark, sf):
    return tidy(stats.correlation_pairs(features(spark, sf), PAIRED))


@query(
    "variance_inflation",
    f"""select variable, {r('v', 'vif', 4)} from (select unnest(['l_quantity', 'l_extendedprice', 'l_partkey']) as variable,
        unnest([a * (d * f - e * e) / det, d * (a * f - c * c) / det, f * (a * d - b * b) / det]) as v from (
        select *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) as det from (
        select 1.0::double as a, gab / sqrt(gaa * gbb) as b, gac / sqrt(gaa * gcc) as c, 1.0::double as d,
            gbc / sqrt(gbb * gcc) as e, 1.0::double as f from (
        select sum(x * x) as gaa, sum(x * y) as gab, sum(x * z) as gac, sum(y * y) as gbb, sum(y * z) as gbc, sum(z * z) as gcc from (
        select l_quantity as x, l_extendedprice as y, cast(l_partkey as double) as z from lineitem)))))""",
)
def variance_inflation(spark, sf):
    return tidy(stats.variance_inflation(given(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"]), 4)


K9 = "[1, 2, 3, 4, 5, 6, 7, 8, 9]"
VIEWS["sommes_croisees"] = "select " + ", ".join(
    f"sum(coalesce(cast({a} as double), 0) * coalesce(cast({b} as double), 0)) as g{i}_{j}" for i, a in enumerate(feat.NUMERIC, 1) for j, b in enumerate(feat.NUMERIC, 1)
) + " from feature_rows"


@query(
    "variance_inflation_all_features",
    f"""select * from (with recursive balaye as (
        select 1 as k, [[unites[i][j] for j in {K9}] for i in {K9}] as a from (select [{', '.join('[' + ', '.join(f'g{i}_{j} / sqrt(g{i}_{i} * g{j}_{j})' for j in range(1, 10)) + ']' for i in range(1, 10))}] as unites from sommes_croisees)
        union all
        select k + 1, [[case when i = k and j = k then 1 / a[k][k] when i = k then a[k][j] / a[k][k] when j = k then -a[i][k] / a[k][k]
            else a[i][j] - a[i][k] * a[k][j] / a[k][k] end for j in {K9}] for i in {K9}] from balaye where k <= 9
    ) select [{', '.join(f"'{c}'" for c in feat.NUMERIC)}][i] as variable, {r('a[i][i]', 'vif', 4)} from balaye, (select unnest({K9}) as i) where k = 10)""",
)
def variance_inflation_all_features(spark, sf):
    return tidy(stats.variance_inflation(features(spark, sf), feat.NUMERIC), 4)


VIEWS["valeurs"] = " union all ".join(
    f"select '{c}' as variable, cast({c} as double) as v, fraud_flag as y from feature_rows where {c} is not null" for c in STUDIED
)
VIEWS["rangs"] = """
    select variable, cast(sum(y) as bigint) as n1, count(*) - cast(sum(y) as bigint) as n0,
        sum(case when y = 1 then rang end) - cast(sum(y) as double) * (sum(y) + 1) / 2 as u,
        sum((cast(ties as double) * ties * ties - ties) / ties) as t from (
            select *, rank() over (partition by variable order by v) + (ties - 1) / 2 as rang from (
                select *, count(*) over (partition by variable, v) as ties from valeurs))
    group by variable
"""


@query(
    "mann_whitney",
    f"""select variable, 'numérique' as type, n1, n0, {r('u', digits=1)},
        {r('(greatest(u, cast(n1 as double) * n0 - u) - cast(n1 as double) * n0 / 2 - 0.5) / sqrt(cast(n1 as double) * n0 / 12 * ((n1 + n0 + 1) - t / (cast(n1 + n0 as double) * (n1 + n0 - 1))))', 'z')},
        {r('abs(1 - 2 * u / (cast(n1 as double) * n0))', 'taille_effet')} from rangs""",
)
def mann_whitney(spark, sf):
    return tidy(stats.mann_whitney(features(spark, sf), STUDIED, "fraud_flag"))


VIEWS["par_client"] = """
    select client_id, transaction_id, fraud_flag as y, 2 * rank() over v + count(*) over (partition by client_id, montant) - 1 as r2,
        row_number() over (partition by client_id order by montant, transaction_id) as pos, count(*) over c as n, sum(fraud_flag) over c as n1
    from transactions where montant is not null and fraud_flag is not null
    window v as (partition by client_id order by montant), c as (partition by client_id)
"""


@query(
    "exact_rank_tests",
    f"""select * from (with recursive petits as materialized (select * from par_client where n1 between 1 and 20 and n - n1 between 1 and 20),
        facons as (
            select client_id, 0::bigint as pos, 0::bigint as k, 0::bigint as s, 1.0::double as ways from (select distinct client_id from petits)
            union all
            select f.client_id, f.pos + 1, f.k + j, f.s + j * p.r2, sum(ways) from facons f join petits p on p.client_id = f.client_id and p.pos = f.pos + 1,
                (select unnest([0, 1]::bigint[]) as j) where f.k + j <= p.n1 group by all
        ), vus as (select client_id, any_value(n1)::bigint as n1, any_value(n)::bigint as n, sum(y * r2)::bigint as seen from petits group by 1)
        select f.client_id, 'montant' as variable, n1, n - n1 as n0, {r('any_value(seen) / 2.0 - n1 * (n1 + 1) / 2.0', 'u', 1)},
            {r('sum(case when abs(s - n1 * (n + 1)) >= abs(seen - n1 * (n + 1)) then ways else 0 end) / sum(ways)', 'p_value')}
        from facons f join vus v on v.client_id = f.client_id and f.pos = v.n and f.k = v.n1 group by f.client_id, n1, n)""",
)
def exact_rank_tests(spark, sf):
    """Do a customer's frauds have other amounts than the rest?  One exact test per customer with both."""
    rows = bank(spark, sf, "transactions").select("client_id", "montant", "fraud_flag")
    return tidy(stats.exact_rank_tests(rows, ["montant"], "fraud_flag", ["client_id"]))


@query("univariate_auc", f"select variable, {r('u / (cast(n1 as double) * n0)', 'auc')} from rangs")
def univariate_auc(spark, sf):
    return tidy(ranks.univariate_auc(features(spark, sf), STUDIED, "fraud_flag"))


def _contingency_sql(source: str, columns, label: str) -> str:
    return " union all ".join(
        f"select '{c}' as variable, cast({c} as varchar) as m, cast(sum({label}) as double) as pos, "
        f"cast(sum(1 - {label}) as double) as neg from {source} where {c} is not null group by 2" for c in columns
    )


def _chi2_sql(table: str) -> str:
    return f"""
        select variable, cast(count(*) - 1 as int) as dof, max(n) as n, sum(part) as chi2 from (
            select *, pow(gp - case when ddl = 1 then least(0.5, gp) else 0 end, 2) / ep
                + pow(gn - case when ddl = 1 then least(0.5, gn) else 0 end, 2) / en as part from (
            select *, abs(pos - ep) as gp, abs(neg - en) as gn from (
            select *, p + q as n, (pos + neg) * p / (p + q) as ep, (pos + neg) * q / (p + q) as en from (
            select *, sum(pos) over (partition by variable) as p, sum(neg) over (partition by variable) as q,
                count(*) over (partition by variable) - 1 as ddl from {table})))) group by variable"""


VIEWS["croise"] = _contingency_sql("feature_rows", TESTED, "fraud_flag")
VIEWS["khi"] = _chi2_sql("croise")
VIEWS["croise_documents"] = _contingency_sql("documents_notes", ("lang", "source", "quality"), "toxic")
VIEWS["khi_documents"] = _chi2_sql("croise_documents")
CHI2_COLUMNS = f"variable, 'catégorielle/binaire' as type, {r('n')}, dof, {r('chi2')}, {r('sqrt(chi2 / n)', 'taille_effet')}"


@query("chi_square", f"select {CHI2_COLUMNS} from khi")
def chi_square(spark, sf):
    return tidy(stats.chi_square(features(spark, sf), TESTED, "fraud_flag"))


@query("chi_square_documents", f"select {CHI2_COLUMNS} from khi_documents")
def chi_square_documents(spark, sf):
    return tidy(stats.chi_square(bank(spark, sf, "documents_notes"), ["lang", "source", "quality"], "toxic"))


@query(
    "feature_verdicts",
    f"""select variable, type, {r('e', 'taille_effet')}, case when e >= 0.3 then 'Fort' when e >= 0.1 then 'Modéré'
        when e >= 0.03 then 'Faible' else 'Négligeable' end as force_effet,
        case when e >= 0.03 then 'Garder' else 'Écarter (effet négligeable malgré p-value)' end as decision from (
        select variable, 'numérique' as type, abs(1 - 2 * u / (cast(n1 as double) * n0)) as e from rangs
        union all select variable, 'catégorielle/binaire', sqrt(chi2 / n) from khi)""",
)
def feature_verdicts(spark, sf):
    return tidy(feature_tests(spark, sf).drop("p_value", "p_value_ajuste"))


@query("feature_tests")
def feature_tests(spark, sf):
    """The verdict table with its p-values, whose tails SQL cannot express."""
    rows = materialise(features(spark, sf).select("fraud_flag", *STUDIED, *TESTED))   # read by both families of tests
    return stats.feature_verdicts(rows, STUDIED, TESTED, "fraud_flag")


@query(
    "adjusted_p_values",
    f"""select variable, {r('p', 'p_value')}, {r('least(1.0, min(p * m / k) over (order by p desc, variable desc rows unbounded preceding))', 'p_value_ajuste')}
        from (select *, count(*) over () as m, row_number() over (order by p, variable) as k from (
            select event_type || '-' || cast(hour(ts) as varchar) as variable, avg(case when value < 2 then 1 else 0 end) as p
            from events group by 1))""",
)
def adjusted_p_values(spark, sf):
    """One made-up test per event type and hour; the share of small values stands for its p-value."""
    groups = given(spark, sf, "events").groupBy(
        F.concat_ws("-", "event_type", F.hour("ts").cast("string")).alias("variable")
    )
    tests = groups.agg(F.avg(F.when(F.col("value") < 2, 1).otherwise(0)).alias("p_value"))
    return tidy(stats.adjusted_p(tests))


# --- curves ------------------------------------------------------------------

VIEWS["courbe"] = """
    select t, pos, neg, tp, fp, p - tp as fn, n - fp as tn, tp / (tp + fp) as precision_, tp / p as recall_, fp / n as fpr_, p, n from (
        select t, pos, neg, sum(pos) over (order by t desc) as tp, sum(neg) over (order by t desc) as fp,
            sum(pos) over () as p, sum(neg) over () as n from (
            select fraud_proba as t, cast(sum(label) as double) as pos, cast(sum(1 - label) as double) as neg from scores
            where label is not null and fraud_proba is not null group by 1))
"""


def scored(spark, sf) -> DataFrame:
    return bank(spark, sf, "scores").select("transaction_id", "montant", "label", "fraud_proba")


def curve(spark, sf) -> DataFrame:
    return ranks.score_curve(scored(spark, sf), "label", "fraud_proba")


@query(
    "precision_recall_curve",
    f"""select {r('t', 'threshold', 9)}, {r('precision_', 'precision', 9)}, {r('recall_', 'recall', 9)} from courbe
        union all select null, 1.0::double, 0.0::double""",
)
def precision_recall_curve(spark, sf):
    return tidy(ranks.precision_recall_points(curve(spark, sf)), 9)


@query(
    "roc_curve",
    f"""select threshold, fpr, tpr from (select {r('t', 'threshold', 9)}, {r('fpr_', 'fpr', 9)}, {r('recall_', 'tpr', 9)},
            lead(fp) over s - 2 * fp + lag(fp) over s as bend_fp, lead(tp) over s - 2 * tp + lag(tp) over s as bend_tp
            from courbe window s as (order by t desc))
        where bend_fp is null or bend_fp <> 0 or bend_tp <> 0 union all select 2.0::double, 0.0::double, 0.0::double""",
)
def roc_curve(spark, sf):
    points = ranks.roc_points(curve(spark, sf))
    # The first point has an infinite threshold, which a rounding cannot carry.
    finite = F.when(F.col("threshold") > 1, 2.0).otherwise(F.col("threshold"))
    return tidy(points.withColumn("threshold", finite), 9)


@query(
    "curve_summary",
    f"""select cast(max(p) as bigint) as n_pos, cast(max(n) as bigint) as n_neg, {r('sum(pos / p * precision_)', 'pr_auc')},
        {r('sum(pos * (tn + neg / 2)) / (max(p) * max(n))', 'roc_auc')}, {r('max(p) / (max(p) + max(n))', 'baseline_pr_auc')},
        {r('sum(pos / p * precision_) / (max(p) / (max(p) + max(n)))', 'lift')},
        {r('coalesce(max(case when precision_ >= 0.8 then recall_ end), 0)', 'recall_at_precision')},
        {r('arg_max(t, [f1, -t])', 'best_threshold_f1')}, {r('max(f1)', 'best_f1')},
        {r('arg_min(t, [cost, t])', 'best_threshold_cost')}, {r('min(cost)', 'min_cost')} from (
        select *, 2 * (precision_ * recall_) / (precision_ + recall_ + 1e-9::double) as f1, fp * 10 + (p - tp) * 1000 as cost,
            n - fp - 0 as tn_ from courbe)""",
)
def curve_summary(spark, sf):
    return tidy(ranks.curve_summary(curve(spark, sf)))


@query(
    "confusion_matrix",
    """select reel, predit, count(label) as nombre from (values (0, 0), (0, 1), (1, 0), (1, 1)) c(reel, predit) left join (
        select label, case when fraud_proba >= 0.8394 then 1 else 0 end as hit from scores where label is not null) s
        on s.label = c.reel and s.hit = c.predit group by 1, 2""",
)
def confusion_matrix(spark, sf):
    return evaluate.confusion(scored(spark, sf), "label", "fraud_proba")


THRESHOLDS = {"0.5": 0.5, "0.7": 0.7, "0.8394": 0.8394}


def _report_sql(name: str, t: float) -> str:
    cells = f"""(select *, tn + fp as n0, fn + tp as n1, tn + fp + fn + tp as n from (select
        cast(count(*) filter (label = 0 and fraud_proba < {t}) as double) as tn, cast(count(*) filter (label = 0 and fraud_proba >= {t}) as double) as fp,
        cast(count(*) filter (label = 1 and fraud_proba < {t}) as double) as fn, cast(count(*) filter (label = 1 and fraud_proba >= {t}) as double) as tp
        from scores))"""
    p0, r0, f0 = "tn / (tn + fn)", "tn / n0", "2 * tn / (2 * tn + fn + fp)"
    p1, r1, f1 = "tp / (tp + fp)", "tp / n1", "2 * tp / (2 * tp + fn + fp)"

    def row(cls, p, q, f, n):
        return (
            f"select '{name}' as seuil, '{cls}' as classe, {r(p, 'precision')}, {r(q, 'recall')}, {r(f, 'f1')}, "
            f"cast({n} as bigint) as support from {cells}"
        )

    mean = lambda a, b: f"({a} + {b}) / 2"
    weighted = lambda a, b: f"({a} * n0 + {b} * n1) / n"
    return " union all ".join(
        [
            row("Normal", p0, r0, f0, "n0"), row("Fraude", p1, r1, f1, "n1"),
            row("accuracy", "null", "null", "(tp + tn) / n", "n"),
            row("macro avg", mean(p0, p1), mean(r0, r1), mean(f0, f1), "n"),
            row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), "n"),
        ]
    )


@query("class_report", " union all ".join(_report_sql(n, t) for n, t in THRESHOLDS.items()))
def class_report(spark, sf):
    return tidy(evaluate.class_report(scored(spark, sf), "label", "fraud_proba", THRESHOLDS))


@query(
    "prediction_table",
    f"""select montant, label as y_true, {r('fraud_proba', 'y_proba')}, case when fraud_proba >= 0.5 then 1 else 0 end as y_pred_default,
        case when fraud_proba >= 0.7 then 1 else 0 end as y_pred_optimal from scores""",
)
def prediction_table(spark, sf):
    return tidy(evaluate.prediction_table(scored(spark, sf), ["montant"], "label", "fraud_proba", 0.7))


@query(
    "score_histogram",
    """select cast(least(60, floor(fraud_proba * 60) + 1) as int) as tranche,
        case label when 0 then 'Normal' when 1 then 'Fraude' else 'Inconnue' end as classe, count(*) as nombre from scores group by 1, 2""",
)
def score_histogram(spark, sf):
    return evaluate.score_histogram(scored(spark, sf), "fraud_proba", "label")


# --- split and encoder -------------------------------------------------------

VIEWS["parts"] = """
    select t.*, case when row_number() over (partition by t.fraud_flag order by md5(cast(transaction_id as varchar) || ':42'), transaction_id)
        <= n_test then 'test' else 'train' end as partie from transactions t join (
        select fraud_flag, n - floor(exact) - case when row_number() over (order by exact - floor(exact) desc, fraud_flag)
                <= train - sum(floor(exact)) over () then 1 else 0 end as n_test from (
            select *, n * train / total as exact from (
                select fraud_flag, count(*) as n, sum(count(*)) over () as total,
                    sum(count(*)) over () - ceil(0.2::double * sum(count(*)) over ()) as train from transactions group by 1))) q
        on t.fraud_flag = q.fraud_flag
"""


def split_transactions(spark, sf) -> DataFrame:
    return model.stratified_split(bank(spark, sf, "transactions"), "transaction_id", "fraud_flag")


@query("stratified_split", "select transaction_id, fraud_flag, partie from parts")
def stratified_split(spark, sf):
    return split_transactions(spark, sf).select("transaction_id", "fraud_flag", "partie")


@query(
    "split_balance",
    f"""select fraud_flag, count(*) filter (partie = 'train') as train_effectif,
        {r("count(*) filter (partie = 'train') * 100.0::double / (select count(*) from parts where partie = 'train')", 'train_pct')},
        count(*) filter (partie = 'test') as test_effectif,
        {r("count(*) filter (partie = 'test') * 100.0::double / (select count(*) from parts where partie = 'test')", 'test_pct')}
        from parts group by 1""",
)
def split_balance(spark, sf):
    return tidy(profile.split_balance(split_transactions(spark, sf), "fraud_flag"))


ENCODED = ("type_transaction", "mode_paiement", "canal", "ville_transaction")
KNOWN_CHANNEL = "case when canal = 'Agence' then 'Guichet' else canal end"
VIEWS["codes"] = " union all ".join(
    f"select '{c}' as variable, m as modalite, cast(row_number() over (order by m) - 1 as double) as code from "
    f"(select distinct coalesce({KNOWN_CHANNEL if c == 'canal' else c}, 'Inconnu') as m from parts where partie = 'train')" for c in ENCODED
)


def fitted_encoder(spark, sf) -> DataFrame:
    """Fitted with one channel under another name, so that the full table holds an unseen category."""
    train = split_transactions(spark, sf).filter(F.col("partie") == "train")
    return model.fit_encoder(train.withColumn("canal", F.expr(KNOWN_CHANNEL)), ENCODED)


@query("encoder_values", "select variable, code, modalite from codes")
def encoder_values(spark, sf):
    return model.encoder_values(fitted_encoder(spark, sf))


@query(
    "encoded_rows",
    "select transaction_id, " + ", ".join(
        f"coalesce((select code from codes where variable = '{c}' and modalite = coalesce(t.{c}, 'Inconnu')), -1.0::double) as {c}" for c in ENCODED
    ) + " from transactions t",
)
def encoded_rows(spark, sf):
    rows = bank(spark, sf, "transactions").select("transaction_id", *ENCODED)
    return model.apply_encoder(rows, fitted_encoder(spark, sf), ENCODED)


@query(
    "unknown_categories",
    """select unnest(['type_transaction', 'mode_paiement', 'canal', 'ville_transaction']) as variable,
        unnest([0::bigint, 0, count(*) filter (canal = 'Agence'), 0]) as inconnues, unnest([count(*), count(*), count(*), count(*)]) as total
        from transactions""",
)
def unknown_categories(spark, sf):
    return quality.unknown_codes(encoded_rows(spark, sf), list(ENCODED))


# --- model -------------------------------------------------------------------

def trained(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
    encoder = model.fit_encoder(train, feat.CATEGORICAL)
    fitted = model.fit_model(model.apply_encoder(train, encoder, feat.CATEGORICAL), feat.FEATURES, feat.LABEL)
    return scoring.model_scorer(fitted, encoder, feat.CATEGORICAL)


PREPARED: dict[tuple, tuple] = {}


def prepared(spark, sf) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]]:
    """(train, test, scorer of trees fitted on train), made once per application and table folder."""
    of = (spark.sparkContext.applicationId, sf)
    if of not in PREPARED:
        clean = feat.clean_features(materialise(features(spark, sf)))
        parts = materialise(model.stratified_split(clean, feat.KEY, feat.LABEL))
        train, test = parts.filter("partie = 'train'"), parts.filter("partie = 'test'")
        PREPARED.clear()
        PREPARED[of] = train, test, trained(train)
    return PREPARED[of]


@query("model_scores")
def model_scores(spark, sf):
    """Every transaction scored by trees trained on the training part."""
    train, test, scorer = prepared(spark, sf)
    out = scoring.score_batch(train.unionByName(test), scorer, 1, RUN_AT, feat.LABEL)
    return tidy(out.withColumn("fraud_proba", F.round("fraud_proba", 6)))


@query("model_run")
def model_run(spark, sf):
    """Train, score the test part, and return the metrics row with its registry alias."""
    train, test, scorer = prepared(spark, sf)
    points = ranks.score_curve(scorer(test), feat.LABEL, "fraud_proba")
    row = registry.metrics_row(
        ranks.curve_summary(points), "run-1", "fraud_detection_model", train.count(), test.count(), len(feat.FEATURES), RUN_AT
    )
    return tidy(row.withColumn("alias", registry.gate_alias()))


@query("permutation_importance")
def permutation_importance(spark, sf):
    _, test, scorer = prepared(spark, sf)
    out = model.permutation_importance(test, scorer, feat.FEATURES, feat.KEY, feat.LABEL)
    return tidy(model.top_importance(out, len(feat.FEATURES)))


@query(
    "permuted_rows",
    f"""select s.essai, s.transaction_id, {r('d.montant', 'montant')} from (
        with recursive numbered as (select transaction_id, row_number() over (order by md5(transaction_id::varchar || ':42'), transaction_id) - 1 as i from transactions),
        sides as (select a, cast(ceil(n::double / a) as bigint) as b, n from (
            select unnest(range(root, root + 64)) as a, n from (select count(*) as n, cast(ceil(sqrt(count(*))) as bigint) as root from numbered))
            order by a * cast(ceil(n::double / a) as bigint) - n, a limit 1),
        walk as (
            select essai, transaction_id, i // b as l, i % b as r, 0 as k from numbered, sides, (select unnest([0, 1, 2]) as essai)
            union all
            select essai, transaction_id,
                case when k % 2 = 0 then (l + ('0x' || substr(md5(r || ':42:montant:' || essai || ':' || (k % 6)), 1, 8))::bigint) % a else l end,
                case when k % 2 = 1 then (r + ('0x' || substr(md5(l || ':42:montant:' || essai || ':' || (k % 6)), 1, 8))::bigint) % b else r end,
                k % 6 + 1 from walk, sides where k < 6 or l * b + r >= n
        ) select essai, transaction_id, l * b + r as i from walk, sides where k = 6 and l * b + r < n) s
        join (select montant, row_number() over (order by md5(transaction_id::varchar || ':42'), transaction_id) - 1 as i from transactions) d on d.i = s.i""",
)
def permuted_rows(spark, sf):
    """The amounts that permutation importance gives the rows, three times over."""
    rows = bank(spark, sf, "transactions").select("transaction_id", "fraud_flag", "montant")
    out = model.permuted_rows(rows, ["montant"], "transaction_id", "fraud_flag", repeats=3)
    return tidy(out.filter("feature <> ''").select("essai", "transaction_id", "montant"))


@query(
    "model_scores_checked",
    f"""select transaction_id, client_id, {r('montant', digits=2)}, fraud_flag as fraud_flag_reel, 1 as model_version,
        '2026-01-01 00:00:00.000000' as date_scoring, true as coherent from transactions""",
)
def model_scores_checked(spark, sf):
    """What SQL can say of ``model_scores``: every transaction once, its truth, and decisions that follow the scores."""
    train, test, scorer = prepared(spark, sf)
    out = scoring.score_batch(train.unionByName(test), scorer, 1, RUN_AT, feat.LABEL)
    p = F.col("fraud_proba")
    sound = p.between(0, 1) & ~F.isnan(p) & (F.col("fraud_predicted") == (p >= 0.5).cast("int"))
    return tidy(out.withColumn("coherent", sound).drop("fraud_proba", "fraud_predicted").withColumn("montant", F.round("montant", 2)))


@query(
    "model_run_checked",
    """select 'run-1' as run_id, 'fraud_detection_model' as model_name, count(*) filter (partie = 'train') as n_train,
        count(*) filter (partie = 'test') as n_test, 16 as n_features, true as mesures_bornees, true as alias_coherent,
        true as mieux_que_le_hasard from parts""",
)
def model_run_checked(spark, sf):
    """What SQL can say of ``model_run``: row counts, the rule of the alias, measures within their bounds and above chance."""
    run = model_run(spark, sf)
    shares = [F.col(c).between(0, 1) for c in ("pr_auc", "roc_auc", "baseline_pr_auc", "recall_at_precision_80", "best_f1", "best_threshold_f1")]
    champion = F.when(F.col("lift") >= registry.MINIMUM_LIFT, "champion").otherwise("challenger")
    return run.select(
        "run_id", "model_name", "n_train", "n_test", "n_features", F.forall(F.array(*shares), lambda c: c).alias("mesures_bornees"),
        (F.col("alias") == champion).alias("alias_coherent"), ((F.col("roc_auc") > 0.5) & (F.col("lift") > 1)).alias("mieux_que_le_hasard"),
    )


@query(
    "importance_checked",
    " union all ".join(f"select '{f}' as feature, true as bornee" for f in feat.FEATURES),
)
def importance_checked(spark, sf):
    """What SQL can say of ``permutation_importance``: one row per feature, losses that a precision can have."""
    bounded = F.col("importance_mean").between(-1, 1) & (F.col("importance_std") >= 0)
    return permutation_importance(spark, sf).select("feature", bounded.alias("bornee"))


# --- registry ----------------------------------------------------------------

VIEWS["evenements"] = """
    select model, case when lift >= 2 then 'champion' else 'challenger' end as alias, version, date
    from versions v join metriques m on v.run_id = m.run_id
"""
VIEWS["titulaires"] = """
    select model, alias, version from (select *, row_number() over (partition by model, alias order by date desc, version desc) as rn
        from evenements) where rn = 1
"""


def alias_events(spark, sf) -> DataFrame:
    return registry.gate_events(bank(spark, sf, "versions"), bank(spark, sf, "metriques"))


@query("alias_holders", "select * from titulaires")
def alias_holders(spark, sf):
    return registry.alias_holders(alias_events(spark, sf))


@query(
    "manual_promotion",
    """select model, case when rang = 1 then 'champion' else 'challenger' end as alias, version from (
        select model, min(version) as version, 1 as rang from versions group by 1
        union all select model, version, 2 from titulaires where alias = 'challenger')""",
)
def manual_promotion(spark, sf):
    """The oldest version of each model promoted by hand, after all that the gate has said."""
    versions = materialise(bank(spark, sf, "versions"))
    oldest = versions.groupBy("model").agg(F.min("version").alias("version")).collect()      # one row per model
    events = alias_events(spark, sf)
    for k, m in enumerate(oldest):
        events = events.unionByName(registry.promotion_event(spark, m["model"], m["version"], datetime(2099, 1, 1), 10**9 + k))
    return registry.alias_holders(events)


@query(
    "serving_versions",
    """select v.model, coalesce(t.version, v.newest) as version, case when t.version is null then 0 else 1 end as est_champion from (
        select model, max(version) as newest from versions group by 1) v left join titulaires t on t.model = v.model and t.alias = 'champion'""",
)
def serving_versions(spark, sf):
    return registry.serving_versions(bank(spark, sf, "versions"), alias_events(spark, sf))


@query(
    "version_list",
    f"""select v.model, v.version, coalesce(a.alias, '—') as alias, coalesce(run_name, '—') as run_name, {rs('pr_auc', 'roc_auc', 'lift')},
        cast(date as varchar) as date, v.run_id, coalesce("user", 'inconnu') as "user" from versions v
        left join (select model, version, string_agg(alias, ', ' order by alias) as alias from titulaires group by 1, 2) a
            on a.model = v.model and a.version = v.version left join metriques m on m.run_id = v.run_id""",
)
def version_list(spark, sf):
    return tidy(registry.version_list(bank(spark, sf, "versions"), bank(spark, sf, "metriques"), alias_events(spark, sf)))


# --- uploads and streams -----------------------------------------------------

def rule_scorer(scale: float):
    """A stand-in score in [0, 1) that SQL can repeat."""
    return lambda rows: rows.withColumn(scoring.SCORE, F.col("montant") / (F.col("montant") + F.lit(scale)))


@query(
    "scored_upload",
    f"""select ligne, montant, type_transaction, case when bad = '' then {r('s', 'score', 4)[:-len(' as score')]} end as score,
        case when bad <> '' then 'ERREUR' when s >= 0.5 then 'FRAUDE' else 'NORMAL' end as decision,
        case when bad <> '' then substr(bad, 1, 80) when s < 0.2 then 'Faible' when s < 0.5 then 'Moyen' when s < 0.8 then 'Élevé'
            else 'Très élevé' end as niveau_risque, case when bad <> '' then bad end as erreurs from (select *, concat_ws(' ; ', e1, raison, e3) as bad,
            case when concat_ws(' ; ', e1, raison, e3) = '' then try_cast(montant as double) / (try_cast(montant as double) + 300) end as s
            from saisies_jugees)""",
)
def scored_upload(spark, sf):
    return scoring.score_upload(bank(spark, sf, "saisies"), rule_scorer(300.0), keep=["ligne"])


def event_stream(spark, sf) -> DataFrame:
    """The events table arriving as a stream of transactions."""
    schema = given(spark, sf, "events").schema
    kind = F.when(F.col("event_type") == "purchase", "Paiement").otherwise("Virement")
    return stream.incoming(spark, sf, schema, pattern="events.parquet").select(
        F.col("event_id").alias("transaction_id"), "user_id", F.col("ts").cast("timestamp").alias("created_at"),
        F.col("value").alias("montant"), kind.alias("type_transaction"), F.lit("Carte").alias("mode_paiement"),
        F.hour("ts").alias("heure"), F.lit(0).alias("is_weekend"), F.lit(0).alias("est_international"),
    )


@query(
    "streamed_scores",
    f"""select event_id as transaction_id, {r('value / (value + 40)', 'fraud_proba')},
        case when value / (value + 40) >= 0.5 then 'FRAUDE' else 'NORMAL' end as decision,
        case when hour(ts) < 6 or hour(ts) >= 22 then 1 else 0 end as is_night from events""",
)
def streamed_scores(spark, sf):
    out = stream.scored(event_stream(spark, sf), rule_scorer(40.0))
    return tidy(stream.drain(out.select("transaction_id", "fraud_proba", "decision", "is_night")))


@query(
    "streamed_alerts",
    f"""select event_id as alert_id, user_id, {r('value / (value + 40)', 'score')},
        case when value / (value + 40) >= 0.8 then 'Très élevé' else 'Élevé' end as niveau_risque from events
        where value / (value + 40) >= 0.5""",
)
def streamed_alerts(spark, sf):
    """Every file is delivered twice; each fraud still raises one alert."""
    rows = event_stream(spark, sf)
    out = stream.scored(rows.unionByName(event_stream(spark, sf)), rule_scorer(40.0))
    alerts = stream.alert_stream(out, "transaction_id", "user_id", "created_at", ["montant", "type_transaction"])
    return tidy(stream.folded(stream.drain(alerts.select("alert_id", "user_id", "score", "niveau_risque"))))


@query(
    "streamed_versions",
    f"""select event_id as transaction_id, case when event_id % 2 = 0 then 1 else 2 end as model_version,
        {r('value / (value + case when event_id % 2 = 0 then 40 else 10 end)', 'fraud_proba')},
        case when value / (value + case when event_id % 2 = 0 then 40 else 10 end) >= 0.5 then 'FRAUDE' else 'NORMAL' end as decision from events""",
)
def streamed_versions(spark, sf):
    """Half of the events arrive before version 2 is promoted, half after; each row names the version that scored it."""
    base = scratch(spark, "versions")
    for version in (1, 2):
        tables.append_history(registry.version_row(spark, "m", version, f"run-{version}", RUN_AT), f"{base}/versions")

    def champion() -> int:
        versions, events = tables.read_history(spark, f"{base}/versions"), tables.read_history(spark, f"{base}/events")
        return registry.resolve_champion(versions, events, "m")

    rows = given(spark, sf, "events")
    kind = F.when(F.col("event_type") == "purchase", "Paiement").otherwise("Virement")
    for version in (1, 2):
        tables.append_history(registry.promotion_event(spark, "m", version, RUN_AT, version), f"{base}/events")
        rows.filter(F.col("event_id") % 2 == version - 1).write.mode("append").parquet(f"{base}/arrived")
        arrived = stream.incoming(spark, f"{base}/arrived", rows.schema).select(
            F.col("event_id").alias("transaction_id"), F.col("value").alias("montant"), kind.alias("type_transaction"),
            F.lit("Carte").alias("mode_paiement"), F.hour("ts").alias("heure"), F.lit(0).alias("is_weekend"), F.lit(0).alias("est_international"),
        )
        scorer_of = lambda v: rule_scorer({1: 40.0, 2: 10.0}[v])
        stream.score_with_champion(arrived, champion, scorer_of, f"{base}/scored", f"{base}/progress").awaitTermination()
    out = spark.read.parquet(f"{base}/scored")
    return tidy(out.select("transaction_id", "model_version", "fraud_proba", "decision"))


@query("streamed_model_scores")
def streamed_model_scores(spark, sf):
    """The stream scored by the trained trees."""
    out = stream.scored(event_stream(spark, sf), prepared(spark, sf)[2])
    return stream.drain(out.select("transaction_id", F.round("fraud_proba", 6).alias("fraud_proba"), "decision"))
