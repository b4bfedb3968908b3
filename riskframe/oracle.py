"""SQL that DuckDB runs on the same tables, one statement per exactly checkable query."""

from __future__ import annotations

from riskframe.queries import AMOUNT_DIGITS, CENTROIDS, DIGITS, NUDGE
from riskframe.schema import FEATURES, LABEL, TRANSACTION_SCHEMA

COLUMNS = [f.name for f in TRANSACTION_SCHEMA]
STRINGS = [f.name for f in TRANSACTION_SCHEMA if f.dataType.typeName() == "string"]
NUMBERS = ["CountryCode", "Amount", "Value", "PricingStrategy", "FraudResult"]

# Common table expressions by name, each with the names it needs.
CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTE[name] = (needs, sql)


def with_ctes(sql: str, *names: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in CTE[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    body = ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order)
    return f"WITH {body}\n{sql}"


def r(expression: str, digits: int = AMOUNT_DIGITS) -> str:
    return f"round({expression} + {NUDGE}, {digits}) + 0.0"


def r6(expression: str) -> str:
    return r(expression, DIGITS)


def _tx(table: str, key: str, customer: str, category: str, channel: str, amount: str,
        value: str, time: str, pricing: str) -> str:
    return f"""SELECT CAST({key} AS VARCHAR) AS TransactionId,
      CAST({key} % 100 AS VARCHAR) AS BatchId,
      CAST({customer} AS VARCHAR) AS AccountId, CAST({customer} AS VARCHAR) AS SubscriptionId,
      CAST({customer} AS VARCHAR) AS CustomerId,
      'UGX' AS CurrencyCode, CAST(256 AS INTEGER) AS CountryCode,
      'P' || CAST({key} % 6 AS VARCHAR) AS ProviderId,
      'PR' || CAST({key} % 23 AS VARCHAR) AS ProductId,
      {category} AS ProductCategory, {channel} AS ChannelId,
      {amount} AS Amount, {value} AS Value, {time} AS TransactionStartTime,
      CAST({pricing} AS INTEGER) AS PricingStrategy,
      CAST(CASE WHEN {key} % 500 = 0 THEN 1 ELSE 0 END AS INTEGER) AS FraudResult
    FROM {table}"""


cte("tx", _tx(
    "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
    "CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END",
    "o_totalprice", "o_orderdate", "o_orderkey % 5"))
cte("ev", _tx(
    "events", "event_id", "user_id", "event_type", "'CH' || CAST(event_id % 4 AS VARCHAR)",
    "CASE WHEN event_type = 'error' THEN -value ELSE value END",
    "value", "ts", "CAST((props->>'$.k') AS INTEGER) % 5"))
cte("gaps", """SELECT * REPLACE (
      CASE WHEN CAST(TransactionId AS BIGINT) % 41 <> 0 THEN Amount END AS Amount,
      CASE WHEN CAST(TransactionId AS BIGINT) % 53 <> 0 THEN ProductCategory END AS ProductCategory,
      CASE WHEN CAST(TransactionId AS BIGINT) % 211 <> 0 THEN CustomerId END AS CustomerId)
    FROM tx""", "tx")
cte("nan", """SELECT * REPLACE (
      CASE WHEN CAST(TransactionId AS BIGINT) % 41 <> 0 THEN Amount END AS Amount) FROM tx""", "tx")
cte("to_second", """SELECT * REPLACE (date_trunc('second', TransactionStartTime) AS TransactionStartTime)
    FROM ev""", "ev")
cte("bad", """SELECT * REPLACE (
      CASE WHEN CAST(TransactionId AS BIGINT) % 97 = 0 THEN 'not-a-date'
           ELSE CAST(TransactionStartTime AS VARCHAR) END AS TransactionStartTime)
    FROM ev""", "ev")
cte("parsed", """SELECT * REPLACE (TRY_CAST(TransactionStartTime AS TIMESTAMP) AS TransactionStartTime)
    FROM bad""", "bad")


def features_sql(source: str, extra: str = "") -> str:
    last = "max(TransactionStartTime)"
    return f"""SELECT CustomerId,
      {r('coalesce(sum(Amount), 0.0)')} AS total_transaction_amount,
      {r('avg(Amount)')} AS average_transaction_amount,
      {r('coalesce(stddev_samp(Amount), 0.0)')} AS std_transaction_amount,
      count(TransactionId) AS transaction_count,
      {r('avg(PricingStrategy)')} AS average_pricing_strategy,
      count(DISTINCT ProductCategory) AS distinct_product_categories,
      CAST(hour({last}) AS BIGINT) AS last_transaction_hour,
      CAST(day({last}) AS BIGINT) AS last_transaction_day,
      CAST(month({last}) AS BIGINT) AS last_transaction_month,
      CAST(year({last}) AS BIGINT) AS last_transaction_year{extra}
    FROM {source}
    WHERE CustomerId IS NOT NULL AND TransactionStartTime IS NOT NULL
    GROUP BY CustomerId"""


def rfm_sql(source: str) -> str:
    return f"""SELECT CustomerId,
      date_sub('day', max(TransactionStartTime),
               (SELECT max(TransactionStartTime) + INTERVAL 1 DAY FROM {source})) AS Recency,
      count(*) AS Frequency, coalesce(sum(Amount), 0.0) AS Monetary
    FROM {source} WHERE CustomerId IS NOT NULL GROUP BY CustomerId"""


cte("features", features_sql("tx"), "tx")
cte("rfm", rfm_sql("tx"), "tx")
cte("scaled", "SELECT *, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS s_{c}"
    for c in ("Recency", "Frequency", "Monetary")) + " FROM rfm", "rfm")
_distance = {
    k: " + ".join(
        f"power(s_{c} - ({x}), 2)" for c, x in zip(("Recency", "Frequency", "Monetary"), centre)
    )
    for k, centre in CENTROIDS.items()
}
cte("clustered", f"""SELECT CustomerId, Recency, Frequency, Monetary,
      CAST(CASE WHEN {_distance[0]} <= {_distance[1]} AND {_distance[0]} <= {_distance[2]} THEN 0
           WHEN {_distance[1]} <= {_distance[2]} THEN 1 ELSE 2 END AS INTEGER) AS Cluster
    FROM scaled""", "scaled")
_SCALED = ("Recency", "Frequency", "Monetary")
N_CLUSTERS, N_STARTS, UNIT, TOLERANCE = 3, 4, 1_000_000, 1e-4


def _apart(point: str, centre: str) -> str:
    return " + ".join(f"({point}.p{i} - {centre}.p{i}) * ({point}.p{i} - {centre}.p{i})" for i in range(3))


cte("points", "SELECT CustomerId, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () * {UNIT}) AS p{i}" for i, c in enumerate(_SCALED))
    + " FROM rfm", "rfm")
for _draw in range(N_CLUSTERS):
    # an exponential race of all customers, each at the speed of its squared distance
    _weight = "1.0" if _draw == 0 else f"(SELECT min({_apart('p', 'c')}) FROM drawn{_draw - 1} c WHERE c.start = s.start)"
    _race = f"""-ln((CAST(CAST('0x' || substr(md5(concat_ws(':', CustomerId, '42', s.start, '{_draw}')), 1, 13) AS BIGINT)
          AS DOUBLE) + 0.5) / CAST({2**52} AS DOUBLE))"""
    _before = f"SELECT * FROM drawn{_draw - 1} UNION ALL " if _draw else ""
    cte(f"drawn{_draw}", f"""{_before}SELECT start, {_draw} AS k, p0, p1, p2 FROM (
        SELECT *, row_number() OVER (PARTITION BY start ORDER BY race / weight, p0, p1, p2) AS place
        FROM (SELECT s.start, p0, p1, p2, {_race} AS race, {_weight} AS weight
              FROM points p, range({N_STARTS}) s(start)) WHERE weight > 0)
      WHERE place = 1""", "points", *([f"drawn{_draw - 1}"] if _draw else []))
# Steps of all starts together until no centre moves. No centre of these tables loses all rows.
_mean = ", ".join(f"floor(CAST(sum(CAST(p{i} AS HUGEINT)) AS DOUBLE) / count(*) + 0.5) AS p{i}" for i in range(3))
_kept = ", ".join(f"CASE WHEN way > {TOLERANCE * UNIT**2} THEN p{i} ELSE o{i} END AS p{i}" for i in range(3))
_old = ", ".join(f"any_value(o{i}) AS o{i}" for i in range(3))
cte("settled", f"""WITH RECURSIVE steps(step, start, k, p0, p1, p2, n, inertia, moves) AS (
      SELECT 0, start, k, p0, p1, p2, CAST(0 AS BIGINT), CAST(0 AS HUGEINT), true FROM drawn{N_CLUSTERS - 1}
      UNION ALL
      SELECT step, start, k, {_kept}, n, inertia, bool_or(way > {TOLERANCE * UNIT**2}) OVER () AS moves
      FROM (SELECT *, sum((p0 - o0) * (p0 - o0) + (p1 - o1) * (p1 - o1) + (p2 - o2) * (p2 - o2)) OVER (PARTITION BY start) AS way
        FROM (SELECT step + 1 AS step, start, k, {_mean}, count(*) AS n, sum(CAST(floor(d) AS HUGEINT)) AS inertia, {_old}
            FROM (SELECT c.step, c.start, c.k, c.p0 AS o0, c.p1 AS o1, c.p2 AS o2, p.p0, p.p1, p.p2, {_apart('p', 'c')} AS d,
                    row_number() OVER (PARTITION BY c.start, p.CustomerId ORDER BY {_apart('p', 'c')}, c.k) AS place
                  FROM points p, steps c WHERE c.moves AND c.step < 300)
            WHERE place = 1 GROUP BY step, start, k)))
    SELECT * FROM steps WHERE step = (SELECT max(step) FROM steps)""", "points", f"drawn{N_CLUSTERS - 1}")
cte("best_start", """SELECT start FROM settled GROUP BY start ORDER BY sum(inertia), start LIMIT 1""", "settled")
cte("kmeans", f"""SELECT CustomerId, k AS Cluster FROM (
      SELECT CustomerId, k, row_number() OVER (PARTITION BY CustomerId ORDER BY {_apart('p', 'c')}, k) AS place
      FROM points p, settled c WHERE start = (SELECT start FROM best_start)) WHERE place = 1""",
    "points", "settled", "best_start")
cte("kmeans_rows", "SELECT rfm.*, CAST(Cluster AS INTEGER) AS Cluster FROM rfm JOIN kmeans USING (CustomerId)", "rfm", "kmeans")
cte("kmeans_risky", """SELECT Cluster FROM kmeans_rows GROUP BY Cluster
    ORDER BY avg(Recency) DESC, avg(Frequency), avg(Monetary), Cluster LIMIT 1""", "kmeans_rows")
cte("profile", """SELECT Cluster, avg(Recency) AS avg_recency, avg(Frequency) AS avg_frequency,
      avg(Monetary) AS avg_monetary, count(*) AS count FROM clustered GROUP BY Cluster""", "clustered")
cte("risky", """SELECT Cluster FROM profile
    ORDER BY avg_recency DESC, avg_frequency, avg_monetary, Cluster LIMIT 1""", "profile")
cte("label", f"""SELECT CustomerId, Recency, Frequency, Monetary, Cluster,
      CAST(CASE WHEN Cluster = (SELECT Cluster FROM risky) THEN 1 ELSE 0 END AS INTEGER) AS {LABEL}
    FROM clustered""", "clustered", "risky")
cte("labelled", f"""SELECT features.*, {LABEL} FROM features JOIN label USING (CustomerId)""",
    "features", "label")

cte("long", " UNION ALL ".join(
    f"SELECT CustomerId, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {LABEL} AS y FROM labelled"
    for c in FEATURES), "labelled")
cte("edges", """SELECT feature, edge,
      row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS edge_index
    FROM (SELECT DISTINCT feature,
            unnest(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS edge
          FROM long GROUP BY feature)""", "long")
cte("binned", """SELECT CustomerId, feature, any_value(y) AS y,
      CASE WHEN count(*) < 2 THEN NULL
           WHEN any_value(value) = min(edge) THEN 1
           WHEN count(*) FILTER (edge < value) IN (0, count(*)) THEN NULL
           ELSE count(*) FILTER (edge < value) END AS bin
    FROM long JOIN edges USING (feature) GROUP BY CustomerId, feature""", "long", "edges")


def woe_sql(source: str) -> str:
    """From (feature, bin as text, y): counts and weight of evidence."""
    return f"""SELECT feature, bin, n, events, n - events AS non_events,
      ln((greatest(n - events, 0.5) / sum(n - events) OVER (PARTITION BY feature))
         / (greatest(events, 0.5) / sum(events) OVER (PARTITION BY feature))) AS woe
    FROM (SELECT feature, bin, count(y) AS n, CAST(coalesce(sum(y), 0) AS BIGINT) AS events
          FROM {source} GROUP BY feature, bin)"""


cte("binned_text", """SELECT CustomerId, feature, y,
      coalesce(CAST(bin AS VARCHAR), 'nan') AS bin FROM binned""", "binned")
cte("woe", woe_sql("binned_text"), "binned_text")
cte("encoded", """SELECT b.CustomerId, b.feature, coalesce(w.woe, 0.0) AS value
    FROM binned_text b LEFT JOIN woe w ON b.feature = w.feature AND b.bin = w.bin""",
    "binned_text", "woe")

CATEGORIES = ("ProductCategory", "ChannelId", "ProductId")
cte("category_text", " UNION ALL ".join(
    f"SELECT TransactionId, '{c}' AS feature, coalesce({c}, 'nan') AS bin, FraudResult AS y FROM gaps"
    for c in CATEGORIES), "gaps")
cte("category_woe", woe_sql("category_text"), "category_text")


def pivot(source: str, value: str, key: str = "CustomerId", columns=FEATURES) -> str:
    cells = ", ".join(f"max(CASE WHEN feature = '{c}' THEN {value} END) AS {c}" for c in columns)
    return f"SELECT {key}, {cells} FROM {source} GROUP BY {key}"


def _scaled(source: str) -> str:
    """(CustomerId, feature, value) standardized per feature."""
    sd = "stddev_pop(value) OVER (PARTITION BY feature)"
    mean = "avg(value) OVER (PARTITION BY feature)"
    return f"""SELECT CustomerId, feature,
      CASE WHEN min(value) OVER (PARTITION BY feature) = max(value) OVER (PARTITION BY feature)
           THEN 0.0 ELSE {r6(f'(value - {mean}) / {sd}')} END AS value FROM {source}"""


cte("scores", f"""SELECT CustomerId, {LABEL} AS label, model,
      round(least(round(CAST(CAST('0x' || substr(md5(CustomerId), start, 4) AS INTEGER) AS DOUBLE)
            / 65535, 2) + CASE WHEN {LABEL} = 1 THEN lift ELSE 0.0 END, 1.0), 2) AS score
    FROM label, (VALUES ('plain', 1, CAST(0.2 AS DOUBLE)), ('strong', 5, CAST(0.4 AS DOUBLE)),
                        ('weak', 9, CAST(0.0 AS DOUBLE))) m(model, start, lift)""", "label")
cte("predicted", """SELECT *, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction
    FROM scores""", "scores")
cte("ranked", """SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
      + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk FROM scores""", "scores")
cte("auc", """SELECT model,
      (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
      / (count(*) FILTER (label = 1) * CAST(count(*) FILTER (label = 0) AS DOUBLE)) AS roc_auc
    FROM ranked GROUP BY model""", "ranked")
cte("confusion", """SELECT model,
      CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
      CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
      CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn
    FROM predicted GROUP BY model""", "predicted")
cte("measures", """SELECT model, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
      coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
      coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM confusion""", "confusion")
cte("classes", """SELECT model, class, tp, support, coalesce(tp / nullif(predicted, 0), 0) AS precision,
      coalesce(tp / nullif(support, 0), 0) AS recall,
      coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1
    FROM (SELECT model, class,
            CAST(count(*) FILTER (label = class AND prediction = class) AS DOUBLE) AS tp,
            count(*) FILTER (label = class) AS support,
            count(*) FILTER (prediction = class) AS predicted
          FROM predicted, (VALUES (0), (1)) c(class) GROUP BY model, class)""", "predicted")

# Numeric columns of the transactions with gaps, one row per value.
cte("numbers", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM gaps" for c in NUMBERS), "gaps")
cte("quartiles", """SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
      quantile_cont(value, 0.75) AS q3 FROM numbers GROUP BY feature""", "numbers")
cte("ranges", """SELECT feature, count(value) AS n, min(value) AS lo, max(value) AS hi,
      stddev_samp(value) AS sd FROM numbers GROUP BY feature""", "numbers")
cte("hist_ranges", """SELECT feature, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
      CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM ranges""", "ranges")

cte("requests", f"""SELECT *, CustomerId || '-' || CAST(chunk AS VARCHAR) AS request_id,
      CASE WHEN number % 13 = 0 THEN 'malformed payload'
           WHEN number % 17 = 1 THEN 'bad or missing field'
           WHEN number % 19 = 2 THEN 'no transactions' END AS reason
    FROM (SELECT *, CAST(TransactionId AS BIGINT) // 256 AS chunk,
            CAST(CustomerId AS BIGINT) + CAST(TransactionId AS BIGINT) // 256 AS number FROM ev)""", "ev")


def _union(template, columns) -> str:
    return " UNION ALL ".join(template(i, c) for i, c in enumerate(columns))


SPARK_TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTION_SCHEMA}
EV_COLUMNS = ", ".join(c for c in COLUMNS if c != "FraudResult")
FENCED = ("Amount", "Value", "PricingStrategy")


def _fence_columns() -> str:
    return ", ".join(
        f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
        for c in FENCED
    )


cte("fences", f"SELECT {_fence_columns()} FROM ev", "ev")


def _correlations(columns, source: str) -> str:
    def cell(a: str, b: str) -> str:
        value = f"corr(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE))"
        return (f"SELECT '{a}' AS x, '{b}' AS y, "
                f"(SELECT CASE WHEN isnan({value}) THEN NULL ELSE {r6(value)} END FROM {source}) AS correlation")

    return " UNION ALL ".join(cell(a, b) for a in columns for b in columns)


def _ordered_rank() -> str:
    return f"""SELECT CustomerId, {LABEL},
      row_number() OVER (PARTITION BY {LABEL} ORDER BY md5(CustomerId || '|42')) AS rk,
      count(*) OVER (PARTITION BY {LABEL}) AS n FROM label"""


cte("ordered", _ordered_rank(), "label")
cte("held_out", f"SELECT CustomerId, {LABEL} AS label FROM ordered WHERE rk <= ceil(round(0.2 * n, 9))",
    "ordered")
# Numeric columns of the transactions whose missing amounts are NaN, and of the capped ones.
cte("nan_numbers", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM nan" for c in NUMBERS), "nan")
cte("capped_numbers", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM ev" for c in ("CountryCode", "FraudResult"))
    + "".join(f""" UNION ALL SELECT '{c}', CASE WHEN {c} < lo_{c} THEN lo_{c}
      WHEN {c} > hi_{c} THEN hi_{c} ELSE CAST({c} AS DOUBLE) END FROM ev, fences""" for c in FENCED),
    "ev", "fences")

# The penalized logistic fit. Its minimum is unique, so any way to it gives the same scores:
# here accelerated descent, whose steps follow from a bound on the curvature. The penalty
# bounds the curvature from below by one, so 25 roots of the upper bound settle ten digits.
cte("spread", """SELECT feature, avg(value) AS mean, stddev_pop(value) AS sd, min(value) = max(value) AS flat
    FROM encoded GROUP BY feature""", "encoded")


def design_sql(source: str) -> str:
    """(CustomerId, x): scaled features in order, then the constant."""
    z = "CASE WHEN flat THEN 0.0 ELSE (value - mean) / sd END"
    cells = ", ".join(f"max({z}) FILTER (feature = '{c}')" for c in FEATURES)
    return f"SELECT CustomerId, [{cells}, 1.0] AS x FROM {source} JOIN spread USING (feature) GROUP BY CustomerId"


cte("design", design_sql("encoded"), "encoded", "spread")
cte("training", f"""SELECT x, CAST({LABEL} AS DOUBLE) AS t,
      count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY {LABEL})) AS w
    FROM ordered JOIN design USING (CustomerId) WHERE rk > ceil(round(0.2 * n, 9))""", "ordered", "design")
cte("bound", "SELECT 1 + sum(w * list_dot_product(x, x)) / 4 AS size FROM training", "training")
_WIDTH = len(FEATURES) + 1
_slopes = ", ".join(
    f"any_value(y)[{j}] - (any_value(y)[{j}] + sum(w * (1 / (1 + exp(-list_dot_product(y, x))) - t) * x[{j}])) / any_value(size)"
    for j in range(1, _WIDTH + 1))
cte("fit", f"""WITH RECURSIVE descent(k, b, y) AS (
      SELECT 0, [{', '.join(['CAST(0 AS DOUBLE)'] * _WIDTH)}], [{', '.join(['CAST(0 AS DOUBLE)'] * _WIDTH)}]
      UNION ALL
      SELECT k + 1, after, list_transform(range(1, {_WIDTH + 1}),
        lambda j: after[j] + (sqrt(size) - 1) / (sqrt(size) + 1) * (after[j] - b[j]))
      FROM (SELECT any_value(k) AS k, any_value(b) AS b, any_value(size) AS size, [{_slopes}] AS after
            FROM descent, bound, training WHERE k < 25 * sqrt(size) HAVING count(*) > 0)
    ) SELECT b FROM descent ORDER BY k DESC LIMIT 1""", "bound", "training")


def scored_sql(source: str) -> str:
    return f"SELECT CustomerId, 1 / (1 + exp(-list_dot_product(b, x))) AS score FROM {source}, fit"


cte("fitted", scored_sql("design"), "design", "fit")
cte("fitted_test", """SELECT CustomerId, label, score, CAST(score > 0.5 AS INTEGER) AS prediction
    FROM held_out JOIN fitted USING (CustomerId)""", "held_out", "fitted")



def _scoring(name: str, source: str) -> None:
    """``<name>_fitted``: scores from transactions."""
    features, long, binned, encoded, design = (f"{name}_{x}" for x in ("features", "long", "binned", "encoded", "design"))
    cte(features, features_sql(source), source)
    cte(long, " UNION ALL ".join(
        f"SELECT CustomerId, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {features}" for c in FEATURES), features)
    cte(binned, f"""SELECT CustomerId, feature,
          coalesce(CAST(CASE WHEN count(*) < 2 THEN NULL
               WHEN any_value(value) = min(edge) THEN 1
               WHEN count(*) FILTER (edge < value) IN (0, count(*)) THEN NULL
               ELSE count(*) FILTER (edge < value) END AS VARCHAR), 'nan') AS bin
        FROM {long} JOIN edges USING (feature) GROUP BY CustomerId, feature""", long, "edges")
    cte(encoded, f"""SELECT b.CustomerId, b.feature, coalesce(w.woe, 0.0) AS value
        FROM {binned} b LEFT JOIN woe w ON b.feature = w.feature AND b.bin = w.bin""", binned, "woe")
    cte(design, design_sql(encoded), encoded, "spread")
    cte(f"{name}_fitted", scored_sql(design), design, "fit")


cte("request_tx", """SELECT * REPLACE (request_id || '#' || CustomerId AS CustomerId)
    FROM requests WHERE reason IS NULL""", "requests")
_scoring("batch", "tx")
_scoring("request", "request_tx")
SCORE_FACTS = "true AS scores_are_probabilities, true AS prediction_follows"


def _describe(source: str) -> str:
    return f"""SELECT feature AS column, count(value) AS count, {r('avg(value)')} AS mean,
      {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min,
      {r('quantile_cont(value, 0.25)')} AS q25, {r('quantile_cont(value, 0.5)')} AS q50,
      {r('quantile_cont(value, 0.75)')} AS q75, {r('max(value)')} AS max
    FROM {source} GROUP BY feature"""


def _model_facts(name: str, points: int | None = None) -> str:
    """What must hold of a fit, from the split alone; models must be better than chance."""
    searched = "" if points is None else (
        f", CAST({points} AS BIGINT) AS n_points, CAST(5 AS BIGINT) AS n_folds, "
        "true AS chosen_from_grid, true AS cv_auc_above_half")
    return with_ctes(
        f"""SELECT '{name}' AS model, count(*) AS n_test, CAST(sum(label) AS BIGINT) AS n_positive,
              {SCORE_FACTS}, true AS auc_above_half{searched} FROM held_out""", "held_out")


def all_oracles() -> dict[str, str]:
    gaps_first = ", ".join(
        f"arg_min({c}, (TransactionStartTime, TransactionId)) FILTER ({c} IS NOT NULL) AS {c}"
        for c in COLUMNS if c != "CustomerId"
    )
    pattern = " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in COLUMNS)
    report_columns = f"{r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1"
    profile_columns = (
        f"{r('avg_recency')} AS avg_recency, {r('avg_frequency')} AS avg_frequency, "
        f"{r('avg_monetary')} AS avg_monetary"
    )
    label_known = f"(SELECT CustomerId, {LABEL} FROM label WHERE CAST(CustomerId AS BIGINT) % 7 <> 0)"
    binary_columns = ", ".join(f"{r6(m)} AS {m}" for m in ("accuracy", "precision", "recall", "f1"))
    return {
        "payload_explode": with_ctes(
            f"SELECT request_id, {EV_COLUMNS} FROM requests WHERE reason IS NULL", "requests"),
        "payload_rejects": with_ctes(
            "SELECT DISTINCT request_id, reason FROM requests WHERE reason IS NOT NULL", "requests"),
        "inferred_types": with_ctes(
            f"""SELECT "column", CASE bit_or(kind) WHEN 1 THEN 'bigint' WHEN 2 THEN 'double' WHEN 3 THEN 'double'
                  WHEN 4 THEN 'timestamp' ELSE 'string' END AS type
                FROM (SELECT "column", CASE WHEN v IS NULL OR v = '' OR lower(v) = 'nan' THEN 0
                    WHEN regexp_full_match(v, '[+-]?(0|[1-9][0-9]{{0,17}})') THEN 1
                    WHEN regexp_full_match(v, '[+-]?[0-9]*[.]?[0-9]*([eE][+-]?[0-9]+)?') AND TRY_CAST(v AS DOUBLE) IS NOT NULL
                      AND NOT regexp_full_match(v, '[+-]?(0[0-9].*|[0-9]+)') THEN 2
                    WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9-]+([T ].*)?') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 4
                    ELSE 8 END AS kind
                  FROM ({_union(lambda i, c: f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS v FROM gaps", COLUMNS)}))
                GROUP BY 1""", "gaps"),
        "drop_columns": with_ctes(f"SELECT {EV_COLUMNS} FROM tx", "tx"),
        "numeric_projection": with_ctes(
            "SELECT TransactionId, Amount, Value, PricingStrategy FROM tx", "tx"),
        "string_projection": with_ctes(f"SELECT {', '.join(STRINGS)} FROM tx", "tx"),
        "lenient_timestamps": with_ctes(
            "SELECT TransactionId, TransactionStartTime FROM parsed", "parsed"),
        "dropped_timestamps": with_ctes(
            "SELECT count(*) AS n_rows, count(*) - count(TransactionStartTime) AS n_dropped FROM parsed",
            "parsed"),
        "timestamp_parts": with_ctes(
            "SELECT TransactionId, " + ", ".join(
                f"CAST({p}(TransactionStartTime) AS BIGINT) AS {p}"
                for p in ("hour", "day", "month", "year")) + " FROM ev", "ev"),
        "elapsed_days": with_ctes(
            """SELECT TransactionId, date_sub('day', TransactionStartTime,
                 (SELECT max(TransactionStartTime) + INTERVAL 1 DAY FROM ev)) AS days FROM ev""", "ev"),
        "clamp_values": with_ctes(
            """SELECT TransactionId, CASE WHEN Amount < 50000 THEN 50000.0
                 WHEN Amount > 300000 THEN 300000.0 ELSE Amount END AS Amount FROM gaps""", "gaps"),
        "fill_missing": with_ctes(
            """SELECT TransactionId, coalesce(Amount, 0.0) AS Amount,
                 coalesce(ProductCategory, 'nan') AS ProductCategory FROM gaps""", "gaps"),
        "customer_features": with_ctes("SELECT * FROM features", "features"),
        "customer_features_hours": with_ctes(features_sql("ev"), "ev"),
        "customer_features_gaps": with_ctes(features_sql("gaps"), "gaps"),
        "customer_features_lenient": with_ctes(features_sql("parsed"), "parsed"),
        "customer_target_max": with_ctes(
            features_sql("tx", ", max(FraudResult) AS Target"), "tx"),
        "rfm": with_ctes(
            f"SELECT CustomerId, Recency, Frequency, {r('Monetary')} AS Monetary FROM rfm", "rfm"),
        "features_and_rfm": with_ctes(
            f"""SELECT f.*, Recency, Frequency, {r('Monetary')} AS Monetary
                FROM ({features_sql('gaps')}) f JOIN ({rfm_sql('gaps')}) USING (CustomerId)""", "gaps"),
        "latest_transaction": with_ctes("SELECT max(TransactionStartTime) AS latest FROM tx", "tx"),
        "first_per_customer": with_ctes(
            f"SELECT CustomerId, {gaps_first} FROM gaps WHERE CustomerId IS NOT NULL GROUP BY CustomerId",
            "gaps"),
        "align_features_label": with_ctes(
            f"SELECT f.*, k.{LABEL} FROM features f JOIN {label_known} k USING (CustomerId)",
            "features", "label"),
        "attach_label": with_ctes(
            f"SELECT f.*, k.{LABEL} FROM features f LEFT JOIN {label_known} k USING (CustomerId)",
            "features", "label"),
        "table_shape": with_ctes(
            f"SELECT count(*) AS n_rows, CAST({len(COLUMNS)} AS BIGINT) AS n_columns FROM tx", "tx"),
        "first_rows": with_ctes(
            "SELECT * FROM tx ORDER BY CAST(TransactionId AS BIGINT) LIMIT 5", "tx"),
        "column_info": with_ctes(_union(
            lambda i, c: f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column, "
                         f"count({c}) AS non_null, '{SPARK_TYPES[c]}' AS dtype FROM gaps", COLUMNS), "gaps"),
        "describe_numeric": with_ctes(_describe("numbers"), "numbers"),
        "describe_numeric_nan": with_ctes(_describe("nan_numbers"), "nan_numbers"),
        "describe_capped": with_ctes(_describe("capped_numbers"), "capped_numbers"),
        "quantiles_nan": with_ctes(
            f"""SELECT feature AS column, p AS probability, {r('q')} AS quantile
                FROM (SELECT feature, unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS p,
                        unnest(quantile_cont(value, [0.05, 0.25, 0.5, 0.75, 0.95])) AS q
                      FROM nan_numbers WHERE feature IN ('Amount', 'Value') GROUP BY feature)""",
            "nan_numbers"),
        "winsorize_nan": with_ctes(
            "SELECT TransactionId, " + ", ".join(
                r(f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} "
                  f"ELSE CAST({c} AS DOUBLE) END") + f" AS {c}" for c in ("Amount", "Value"))
            + f" FROM nan, (SELECT {_fence_columns()} FROM nan)", "nan"),
        "customer_features_formats": with_ctes(features_sql("to_second"), "to_second"),
        "high_risk_target": with_ctes(
            f"""SELECT CustomerId, Recency, Frequency, {r('Monetary')} AS Monetary, Cluster,
                  CAST(Cluster = (SELECT Cluster FROM kmeans_risky) AS INTEGER) AS {LABEL},
                  true AS label_is_binary, true AS label_is_risky_cluster FROM kmeans_rows""",
            "kmeans_rows", "kmeans_risky"),
        "kmeans_rfm": with_ctes(
            "SELECT Cluster, count(*) AS n_customers, " + ", ".join(
                f"{r(f'avg(({c} - m{c}) / d{c})')} AS centre_{c.lower()}" for c in _SCALED)
            + ", true AS all_nearest FROM kmeans_rows, (SELECT " + ", ".join(
                f"avg({c}) AS m{c}, stddev_pop({c}) AS d{c}" for c in _SCALED) + " FROM rfm) GROUP BY Cluster",
            "kmeans_rows"),
        "kmeans_starts": with_ctes(
            "SELECT CAST(start AS INTEGER) AS start, CAST(k AS INTEGER) AS Cluster, n AS n_customers, " + ", ".join(
                f"{r(f'p{i} / CAST({UNIT} AS DOUBLE)')} AS centre_{c.lower()}" for i, c in enumerate(_SCALED))
            + f""", {r(f'CAST(sum(inertia) OVER (PARTITION BY start) AS DOUBLE) / CAST({UNIT**2} AS DOUBLE)')} AS inertia,
              start = (SELECT start FROM best_start) AS chosen FROM settled""", "settled", "best_start"),
        "logistic_baseline": with_ctes(
            f"""SELECT 'logistic_baseline' AS model, n_test, n_positive, {r6('roc_auc')} AS roc_auc,
                  {r6('(tp + tn) / n_test')} AS accuracy, {r6('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
                  {r6('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall,
                  {r6('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,
                  {SCORE_FACTS}, true AS auc_above_half
                FROM (SELECT count(*) AS n_test, CAST(sum(label) AS BIGINT) AS n_positive,
                    CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
                    CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
                    CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
                    CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM fitted_test),
                  (SELECT avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) AS roc_auc
                   FROM (SELECT round(score, 12) AS score FROM fitted_test WHERE label = 1) p,
                     (SELECT round(score, 12) AS score FROM fitted_test WHERE label = 0) n)""", "fitted_test"),
        "logistic_tuned": _model_facts("logistic_tuned", 8),
        "forest_baseline": _model_facts("forest_baseline"),
        "forest_tuned": _model_facts("forest_tuned", 108),
        "gbt_baseline": _model_facts("gbt_baseline"),
        "gbt_tuned": _model_facts("gbt_tuned", 54),
        "class_probability": with_ctes(
            f"""SELECT CustomerId, 'logistic_baseline' AS model, label, {r6('score')} AS score, prediction, {SCORE_FACTS}
                FROM fitted_test""", "fitted_test"),
        "score_transactions_batch": with_ctes(
            f"""SELECT CustomerId AS customer_id, {r6('score')} AS risk_probability,
                  CAST(score > 0.5 AS INTEGER) AS {LABEL}, {SCORE_FACTS} FROM batch_fitted""", "batch_fitted"),
        "score_payloads_batch": with_ctes(
            f"""SELECT split_part(CustomerId, '#', 1) AS request_id, split_part(CustomerId, '#', 2) AS customer_id,
                  {r6('score')} AS risk_probability, CAST(score > 0.5 AS INTEGER) AS {LABEL}, {SCORE_FACTS}
                FROM request_fitted""", "request_fitted"),
        "describe_categorical": with_ctes(
            f"""SELECT c AS column, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique,
                  arg_min(v, (-n, v)) AS top, max(n) AS freq
                FROM ({_union(lambda i, c: f"SELECT '{c}' AS c, {c} AS v, count(*) AS n FROM gaps "
                                           f"WHERE {c} IS NOT NULL GROUP BY {c}", STRINGS)})
                GROUP BY c""", "gaps"),
        "missing_report": with_ctes(
            f"""SELECT column_name AS column, missing AS missing_count,
                  {r6('100.0 * missing / n')} AS missing_percent
                FROM ({_union(lambda i, c: f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
                                           f"count(*) AS n FROM gaps", COLUMNS)}) WHERE missing > 0""",
            "gaps"),
        "missing_pattern": with_ctes(
            f"SELECT {pattern} AS pattern, count(*) AS n FROM gaps GROUP BY 1", "gaps"),
        "value_counts": with_ctes(_union(
            lambda i, c: f"SELECT '{c}' AS column, {c} AS value, count(*) AS n FROM gaps "
                         f"WHERE {c} IS NOT NULL GROUP BY {c}", STRINGS), "gaps"),
        "correlation_matrix": with_ctes(_correlations(NUMBERS, "gaps"), "gaps"),
        "redundant_pairs": with_ctes(
            f"""SELECT x, y, correlation FROM ({_correlations(FEATURES, 'features')})
                WHERE x < y AND abs(correlation) >= 0.5""", "features"),
        "constant_columns": with_ctes(
            f"""SELECT c AS column, lo AS value FROM ({_union(
                lambda i, c: f"SELECT '{c}' AS c, CAST(min({c}) AS VARCHAR) AS lo, "
                             f"CAST(max({c}) AS VARCHAR) AS hi FROM tx", COLUMNS)}) WHERE lo = hi""", "tx"),
        "class_balance": with_ctes(
            f"""SELECT FraudResult AS label, count(*) AS n,
                  {r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS percent
                FROM tx GROUP BY FraudResult""", "tx"),
        "quantiles": with_ctes(
            f"""SELECT feature AS column, p AS probability, {r('q')} AS quantile
                FROM (SELECT feature, unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS p,
                        unnest(quantile_cont(value, [0.05, 0.25, 0.5, 0.75, 0.95])) AS q
                      FROM numbers WHERE feature IN ('Amount', 'Value', 'PricingStrategy')
                      GROUP BY feature)""", "numbers"),
        "boxplot_stats": with_ctes(
            f"""SELECT feature AS column,
                  {r('min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
                  {r('max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
                  count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers,
                  {r('any_value(q1)')} AS q1, {r('any_value(q2)')} AS median, {r('any_value(q3)')} AS q3
                FROM numbers JOIN quartiles USING (feature) WHERE feature <> 'FraudResult'
                GROUP BY feature""", "numbers", "quartiles"),
        "histogram": with_ctes(
            f"""SELECT h.feature, b AS bin, {r('lo + b * (hi - lo) / 30')} AS bin_start,
                  {r('lo + (b + 1) * (hi - lo) / 30')} AS bin_end, coalesce(n, 0) AS n
                FROM hist_ranges h CROSS JOIN range(30) t(b)
                LEFT JOIN (SELECT feature, least(CAST(floor((value - lo) / (hi - lo) * 30) AS BIGINT), 29) AS b,
                             count(*) AS n
                           FROM numbers JOIN hist_ranges USING (feature) WHERE value IS NOT NULL
                           GROUP BY 1, 2) c USING (feature, b)""", "numbers", "hist_ranges"),
        "kde": with_ctes(
            f"""SELECT feature, point, {r('x')} AS x,
                  {r('1e6 * total / (n * bw * sqrt(2 * pi()))')} AS density,
                  {r('total / (bw * sqrt(2 * pi())) * (hi - lo) / 30')} AS curve
                FROM (SELECT g.feature, point, any_value(x) AS x, any_value(bw) AS bw,
                        any_value(n) AS n, any_value(lo) AS lo, any_value(hi) AS hi,
                        sum(exp(-0.5 * ((x - value) / bw) * ((x - value) / bw))) AS total
                      FROM (SELECT feature, n, lo, hi, b AS point, lo + b * ((hi - lo) / 199) AS x,
                              power(n, -0.2) * sd AS bw
                            FROM ranges CROSS JOIN range(200) t(b) WHERE sd > 0) g
                      JOIN (SELECT * FROM numbers WHERE value IS NOT NULL) v USING (feature)
                      GROUP BY g.feature, point)""", "numbers", "ranges"),
        "winsorize": with_ctes(
            "SELECT TransactionId, " + ", ".join(
                r(f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} "
                  f"ELSE CAST({c} AS DOUBLE) END") + f" AS {c}" for c in FENCED)
            + ", FraudResult FROM ev, fences", "fences"),
        "bin_edges_quantile": with_ctes(
            f"SELECT feature, edge_index, {r('edge')} AS edge FROM edges", "edges"),
        "bin_edges_uniform": with_ctes(
            f"""SELECT feature, i AS edge_index,
                  {r('''CASE WHEN lo = hi THEN lo + (i - 5) / 5.0 * (CASE WHEN lo = 0 THEN 0.001 ELSE 0.001 * abs(lo) END)
                             WHEN i = 0 THEN lo - 0.001 * (hi - lo)
                             ELSE lo + i * (hi - lo) / 10 END''')} AS edge
                FROM (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY feature)
                CROSS JOIN range(11) t(i)""", "long"),
        "assign_bin": with_ctes(pivot("binned", "bin"), "binned"),
        "woe_fit": with_ctes(
            f"SELECT feature, bin, n, events, non_events, {r6('woe')} AS woe FROM woe", "woe"),
        "woe_fit_categories": with_ctes(
            f"SELECT feature, bin, n, events, non_events, {r6('woe')} AS woe FROM category_woe",
            "category_woe"),
        "woe_transform": with_ctes(pivot("encoded", r6("value")), "encoded"),
        "woe_transform_categories": with_ctes(
            pivot("(SELECT * FROM category_text t JOIN category_woe w USING (feature, bin))",
                  r6("woe"), "TransactionId", CATEGORIES), "category_text", "category_woe"),
        "standardized_features": with_ctes(pivot(f"({_scaled('long')})", "value"), "long"),
        "model_features": with_ctes(pivot(f"({_scaled('encoded')})", "value"), "encoded"),
        "cluster_profile_fixed": with_ctes(
            f"SELECT Cluster, {profile_columns}, count FROM profile", "profile"),
        "high_risk_pick_fixed": with_ctes(
            f"SELECT CustomerId, Recency, Frequency, {r('Monetary')} AS Monetary, Cluster, {LABEL} FROM label",
            "label"),
        "high_risk_cluster_fixed": with_ctes("SELECT Cluster FROM risky", "risky"),
        "stratified_split": with_ctes(
            f"""SELECT CustomerId, {LABEL}, CAST(CASE WHEN rk <= ceil(round(0.2 * n, 9)) THEN 1 ELSE 0 END
                AS INTEGER) AS is_test FROM ordered""", "ordered"),
        "stratified_split_whole": with_ctes(
            f"""SELECT CustomerId, {LABEL}, CAST(rk <= n_test AS INTEGER) AS is_test FROM ordered JOIN (
                  SELECT {LABEL}, drawn * size // total + CAST(row_number() OVER (
                      ORDER BY drawn * size % total DESC, {LABEL}) <= drawn - sum(drawn * size // total) OVER () AS BIGINT) AS n_test
                  FROM (SELECT {LABEL}, count(*) AS size, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
                      CAST(ceil(round(0.2 * sum(count(*)) OVER (), 9)) AS BIGINT) AS drawn FROM ordered GROUP BY {LABEL})
                ) USING ({LABEL})""", "ordered"),
        "stratified_folds": with_ctes(
            f"""SELECT CustomerId, {LABEL}, CAST({' + '.join(
                f'CASE WHEN rk > n * {j} // 5 THEN 1 ELSE 0 END' for j in range(1, 5))} AS INTEGER) AS fold
                FROM ordered""", "ordered"),
        "class_counts": with_ctes(f"SELECT {LABEL}, count(*) AS n FROM label GROUP BY {LABEL}", "label"),
        "balanced_weights": with_ctes(
            f"""SELECT CustomerId, {LABEL},
                  {r6(f'count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY {LABEL}))')} AS weight
                FROM label""", "label"),
        "roc_auc": with_ctes(f"SELECT model, {r6('roc_auc')} AS roc_auc FROM auc", "auc"),
        "binary_metrics": with_ctes(f"SELECT model, {binary_columns} FROM measures", "measures"),
        "classification_report": with_ctes(
            f"""SELECT model, CAST(class AS VARCHAR) AS row, {report_columns}, support FROM classes
                UNION ALL
                SELECT model, 'accuracy', {r6('sum(tp) / sum(support)')}, {r6('sum(tp) / sum(support)')},
                  {r6('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM classes GROUP BY model
                UNION ALL
                SELECT model, 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')},
                  CAST(sum(support) AS BIGINT) FROM classes GROUP BY model
                UNION ALL
                SELECT model, 'weighted avg', {r6('sum(precision * support) / sum(support)')},
                  {r6('sum(recall * support) / sum(support)')}, {r6('sum(f1 * support) / sum(support)')},
                  CAST(sum(support) AS BIGINT) FROM classes GROUP BY model""", "classes"),
        "model_comparison": with_ctes(
            f"SELECT model, {r6('roc_auc')} AS roc_auc, {binary_columns} FROM auc JOIN measures USING (model)",
            "auc", "measures"),
        "best_run": with_ctes(
            f"SELECT model AS run_name, {r6('roc_auc')} AS roc_auc FROM auc ORDER BY auc.roc_auc DESC, model LIMIT 1",
            "auc"),
    }
