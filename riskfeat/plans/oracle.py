"""The registered queries as independent SQL, to check results against."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from riskfeat.functions.stats import BASIC, SPREAD, WITH_STD
from riskfeat.plans.cube_queries import HOUR_RANGES, MOMENTS, WINDOWS
from riskfeat.plans.feature_matrix import BLEND_FAMILIES, BLEND_WEIGHTS

ACT = """act AS (
  SELECT user_id, event_id AS seq, CAST(k AS VARCHAR) AS ip, CAST(k % 10 AS VARCHAR) AS ip_3,
    CAST(nullif(k % 7, 0) AS VARCHAR) AS k7, event_type, amount, d AS days_diff, hour(ts) AS hour, d % 7 AS week,
    CAST(d AS BIGINT) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS timestamp,
    CASE WHEN event_type = 'purchase' THEN 'trans' ELSE 'op' END AS property,
    CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END AS rank
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, CAST(value AS DECIMAL(18,2)) AS amount,
          CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS BIGINT) AS d FROM events)
)"""
PUR = ACT + ", pur AS (SELECT * FROM act WHERE property = 'trans')"
COM = """com AS (
  SELECT o_custkey AS user_id, o_orderkey AS seq, o_orderstatus AS status, o_orderpriority AS priority,
    nullif(o_orderstatus, 'P') AS status_n, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS days_diff,
    CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS BIGINT) % 7 AS week
  FROM orders
)"""
FOLD = "CAST(CAST('0x' || substr(md5('2020:' || CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS BIGINT)"
PROF = f"""prof AS (
  SELECT *, CASE WHEN label IS NOT NULL THEN f END AS fold FROM (
    SELECT c_custkey AS user_id, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_acctbal < 0 AS BIGINT) END AS label,
      c_nationkey AS nation, c_mktsegment AS segment, nullif(c_mktsegment, 'BUILDING') AS segment_n,
      c_nationkey || '_' || c_mktsegment AS nation_segment, {FOLD} AS f
    FROM customer)
)"""
SESS = (
    ACT
    + """, gaps AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w > 600 THEN 1 ELSE 0 END AS brk
  FROM act WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, rank, seq)),
sess AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY timestamp, rank, seq) AS BIGINT) AS session FROM gaps)"""
)
PSESS = (
    PUR
    + """, gaps AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w > 600 THEN 1 ELSE 0 END AS brk
  FROM pur WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, seq)),
sess AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY timestamp, seq) AS session FROM gaps)"""
)


def r(expr: str, digits: int = 6) -> str:
    """Rounded through a decimal of 9 places, as the queries are."""
    double = f"CAST({expr} AS DOUBLE)"
    return f"(coalesce(CAST(round(TRY_CAST({double} AS DECIMAL(38,9)), {digits}) AS DOUBLE), round({double}, {digits})) + 0.0)"


def stat(kind: str, x: str, where: str | None = None) -> str:
    """One aggregate, rounded like the query output; ``where`` keeps some rows."""
    f = f" FILTER (WHERE {where})" if where else ""
    d = f"CAST({x} AS DOUBLE)"
    return {
        "mean": r(f"CAST(sum({x}){f} AS DOUBLE) / nullif(count({x}){f}, 0)"),
        "std": r(f"stddev_samp({d}){f}", 4),
        "max": f"max({x}){f}",
        "min": f"min({x}){f}",
        "sum": f"sum({x}){f}",
        "median": r(f"median({d}){f}"),
        "count": f"CAST(count({x}){f} AS BIGINT)",
    }[kind]


def stats(
    x: str, kinds: Iterable[str], name: str, where: str | None = None, suffix: str = "", money: bool = True, null: bool = False
) -> str:
    """A select list with the column names of the library's ``stats_of``."""
    out = []
    for kind in kinds:
        e = stat(kind, x, where)
        if kind in ("max", "min", "sum"):
            e = r(e) if money else f"CAST({e} AS BIGINT)"
        if kind == "count" and null:
            e = f"nullif({e}, 0)"
        out.append(f'{e} AS "{name}_{kind}{suffix}"')
    return ", ".join(out)


def _trailing() -> str:
    return ", ".join(
        stats("amount", WITH_STD, "amount", f"days_diff > {w}", f"_{w}d", null=True) for w in (27, 23, 15, 10, 5)
    )


def _cube_trailing() -> str:
    return ", ".join(stats("amount", MOMENTS, "amount", f"days_diff > {w}", f"_{w}d", null=True) for w in WINDOWS)


def _cube_hours() -> str:
    return ", ".join(
        stats("amount", MOMENTS, "hour_amount", f"hour > {a} AND hour <= {b}", f"_{a}_{b}", null=True)
        for a, b in HOUR_RANGES[:3]
    )


def _cube_calendar() -> str:
    slots = [(f"week_{d}_cnt", f"days_diff % 7 = {d}") for d in range(7)]
    slots += [(f"hour_{a}_{b}_cnt", f"hour > {a} AND hour <= {b}") for a, b in HOUR_RANGES]
    return ", ".join(f"nullif(count(*) FILTER (WHERE {where}), 0) AS {name}" for name, where in slots)


def _shared_values(columns: Iterable[str]) -> str:
    per_value = "SELECT min(property) AS a, max(property) AS b FROM act WHERE {c} IS NOT NULL GROUP BY {c}"
    parts = [
        f"SELECT '{c}' AS field, count(*) FILTER (WHERE a <> b) AS n_shared, count(*) AS n_all, CAST(1 AS BIGINT) AS within "
        f"FROM ({per_value.format(c=c)})"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _hours() -> str:
    return ", ".join(
        stats("amount", WITH_STD, "hour_amount", f"hour > {a} AND hour <= {b}", f"_{a}_{b}", null=True)
        for a, b in ((0, 6), (6, 12), (12, 18))
    )


def _pivot(table: str, column: str, values: Iterable[str], x: str, money: bool) -> str:
    kinds = ("count", "sum", "mean", "max", "min", "median")
    cols = []
    for v in values:
        for kind in kinds:
            e = stat(kind, x, f"{column} = '{v}'")
            if kind in ("sum", "max", "min"):
                e = r(e) if money else f"CAST({e} AS BIGINT)"
            cols.append(f'coalesce({e}, 0) AS "{column}_{v}_{x}_{kind}"')
    return ", ".join(cols)


def _popularity_rows(columns: Iterable[str]) -> str:
    ctes = ", ".join(
        f"p_{c} AS (SELECT {c}, count(DISTINCT user_id) AS n FROM act WHERE {c} IS NOT NULL GROUP BY 1)" for c in columns
    )
    cols = ", ".join(f"p_{c}.n AS log_{c}_user_nuniq" for c in columns)
    joins = " ".join(f"LEFT JOIN p_{c} ON act.{c} = p_{c}.{c}" for c in columns)
    return f"WITH {ACT}, {ctes} SELECT act.seq, act.user_id, {cols} FROM act {joins}"


def _popularity_users(columns: Iterable[str]) -> str:
    ctes = ", ".join(
        f"p_{c} AS (SELECT {c}, count(DISTINCT user_id) AS n FROM act WHERE {c} IS NOT NULL GROUP BY 1)" for c in columns
    )
    joins = " ".join(f"LEFT JOIN p_{c} ON act.{c} = p_{c}.{c}" for c in columns)
    cols = ", ".join(stats(f"p_{c}.n", SPREAD, f"log_{c}_user_nuniq", money=False) for c in columns)
    return f"WITH {ACT}, {ctes} SELECT act.user_id, {cols} FROM act {joins} GROUP BY 1"


def _lifespan(columns: str, name: str) -> str:
    keys = columns.split(",")
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""WITH {ACT} SELECT {columns}, count(DISTINCT user_id) AS log_cnt_user_{name},
      CAST(min(days_diff) AS BIGINT) AS log_early_day_{name}, CAST(max(days_diff) AS BIGINT) AS log_later_day_{name},
      CAST(max(days_diff) - min(days_diff) AS BIGINT) AS log_range_day_{name}
      FROM act WHERE {known} GROUP BY {columns}"""


def _shared(values: dict[str, str]) -> str:
    base = f"""{COM}, res AS (SELECT com.user_id, days_diff, l_suppkey, l_partkey
      FROM com JOIN lineitem ON l_orderkey = seq)"""
    ctes, joins, cols = [], [], []
    for name, value in values.items():
        ctes.append(
            f"""u_{name} AS (SELECT DISTINCT user_id, {value} AS v FROM res), v_{name} AS (SELECT {value} AS v,
            count(DISTINCT user_id) AS cnt_user, min(days_diff) AS early_day, max(days_diff) AS later_day,
            max(days_diff) - min(days_diff) AS range_day FROM res GROUP BY 1),
            s_{name} AS (SELECT user_id, {_shared_measures(name)} FROM u_{name} JOIN v_{name} USING (v) GROUP BY 1)"""
        )
        joins.append(f"s_{name}")
        cols.append(f"s_{name}.* EXCLUDE (user_id)")
    first = joins[0]
    rest = " ".join(f"JOIN {j} ON {j}.user_id = {first}.user_id" for j in joins[1:])
    return f"WITH {base}, {', '.join(ctes)} SELECT {first}.user_id, {', '.join(cols)} FROM {first} {rest}"


def _shared_measures(name: str) -> str:
    out = []
    for m in ("cnt_user", "early_day", "later_day", "range_day"):
        out.append(stats(m, ("max", "min", "mean"), f"relate_{m}_{name}", money=False))
        # duckdb's skewness is adjusted, and NULL when there is no spread
        skew = f"CASE WHEN count(*) >= 3 THEN CASE WHEN max({m}) = min({m}) THEN 0.0 ELSE skewness({m}) END END"
        out.append(f"{r(skew, 4)} AS relate_{m}_{name}_skew")
    return ", ".join(out)


def _calendar() -> str:
    weeks = ", ".join(f"nullif(count(*) FILTER (WHERE week = {d}), 0) AS week_{d}_cnt" for d in range(7))
    bounds = (-1, 8, 12, 15, 23)
    parts = ", ".join(
        f"nullif(count(*) FILTER (WHERE hour > {a} AND hour < {b}), 0) AS time_period_{i}_cnt"
        for i, (a, b) in enumerate(zip(bounds, bounds[1:]))
    )
    return f"{weeks}, {parts}"


NUM = f"""{COM}, num AS (SELECT c_custkey AS user_id, c_nationkey AS nation, n_orders, n_open, last_day FROM customer
  LEFT JOIN (SELECT user_id, count(*) AS n_orders, count(*) FILTER (WHERE status = 'O') AS n_open,
    max(days_diff) AS last_day FROM com GROUP BY 1) o ON o.user_id = c_custkey)"""


def _scaled(columns: Iterable[str]) -> str:
    return ", ".join(
        f"CAST({c} - min({c}) OVER () AS DOUBLE) / nullif(max({c}) OVER (), 0) AS {c}" for c in columns
    )


def _crosses(columns: list[str]) -> str:
    out = []
    for a, b in combinations(columns, 2):
        out += [
            f"{r(f'{a} / nullif({b}, 0)')} AS {a}_div_{b}",
            f"{r(f'{a} - {b}')} AS {a}_sub_{b}",
            f"{r(f'{a} * {b}')} AS {a}_mul_{b}",
            f"{r(f'{a} + {b}')} AS {a}_sum_{b}",
        ]
    return ", ".join(out)


CATEGORIES = ("nation", "segment_n", "nation_segment")
# trainings: fold t is left out; -1 leaves nothing out and serves the users to score
TRAIN = f"""{PROF}, trainings AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS t),
tot AS (SELECT t, sum(label) AS s, count(label) AS n FROM prof, trainings
  WHERE label IS NOT NULL AND fold <> t GROUP BY t)"""


def _refits(code: str, fill: str, suffix: str, digits: int = 6, extra: str = "") -> str:
    """k refits spelled out: one table of codes per training, matched to the held-out users."""
    ctes, cols, joins = [], [], []
    for c in CATEGORIES:
        ctes.append(
            f"""g_{c} AS (SELECT t, v, s0, n0, s AS ts, n AS tn, {code} AS code FROM (
              SELECT t, {c} AS v, sum(label) AS s0, count(label) AS n0 FROM prof, trainings
              WHERE label IS NOT NULL AND fold <> t AND {c} IS NOT NULL GROUP BY t, {c}) JOIN tot USING (t))"""
        )
        ctes.append(f"c_{c} AS (SELECT t, avg(code) AS code FROM g_{c} GROUP BY t)")
        ctes.append(
            f"""r_{c} AS (SELECT user_id, label, coalesce(fold, -1) AS t, g_{c}.code AS code FROM prof
              LEFT JOIN g_{c} ON g_{c}.v = prof.{c} AND g_{c}.t = coalesce(fold, -1))"""
        )
        filler = {
            "prior": "tot.s * 1.0 / tot.n",
            "category_mean": f"c_{c}.code",
            "own_mean": f"(SELECT avg(code) FROM r_{c} WHERE label IS NOT NULL)",
        }[fill]
        ctes.append(
            f"""o_{c} AS (SELECT user_id, {r(f'coalesce(r_{c}.code, {filler})', digits)} AS x FROM r_{c}
              LEFT JOIN tot USING (t) LEFT JOIN c_{c} USING (t))"""
        )
        cols.append(f"o_{c}.x AS {c}_{suffix}")
        joins.append(f"JOIN o_{c} ON o_{c}.user_id = prof.user_id")
    return f"WITH {TRAIN}, {', '.join(ctes)} SELECT prof.user_id, {', '.join(cols)} FROM prof {' '.join(joins)}"


MEAN_CODE = "s0 * 1.0 / n0"
WOE_CODE = "ln(((s0 + 1e-6) / (s + 1e-6)) / ((n0 - s0 + 1e-6) / (n - s + 1e-6)))"
ME_CODE = "(s0 + CAST(s AS DOUBLE) / n) / (n0 + 1)"
_PC, _P = "(CAST(s0 AS DOUBLE) / n0)", "(CAST(s AS DOUBLE) / n)"
_VC, _V = f"({_PC} * (1 - {_PC}) / n0)", f"({_P} * (1 - {_P}) / n)"
_B = f"coalesce({_VC} / nullif({_VC} + {_V}, 0), 0)"
JS_CODE = f"(1 - {_B}) * {_PC} + {_B} * {_P}"


def _leave_one_out() -> str:
    cols = ", ".join(
        f"""{r(f'''coalesce(CAST((sum(label) OVER w_{c} - coalesce(label, 0)) AS DOUBLE)
        / nullif(count(label) OVER w_{c} - CASE WHEN label IS NULL THEN 0 ELSE 1 END, 0) , NULL)''')} AS {c}_raw"""
        for c in CATEGORIES
    )
    windows = ", ".join(f"w_{c} AS (PARTITION BY {c})" for c in CATEGORIES)
    prior = "(SELECT sum(label) * 1.0 / count(label) FROM prof)"
    out = ", ".join(
        f"CASE WHEN {c} IS NULL THEN {r(prior)} ELSE coalesce({c}_raw, {r(prior)}) END AS {c}_loo" for c in CATEGORIES
    )
    return f"WITH {PROF} SELECT user_id, {out} FROM (SELECT *, {cols} FROM prof WINDOW {windows})"


def _ordered_rows() -> str:
    prior = "(SELECT sum(label) * 1.0 / count(label) FROM prof)"
    cols = ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN {r(f'''(coalesce(sum(label) OVER w_{c}, 0) + {prior}) / (count(label) OVER w_{c} + 1)''')}
        END AS {c}_ordered"""
        for c in CATEGORIES
    )
    windows = ", ".join(
        f"w_{c} AS (PARTITION BY {c} ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in CATEGORIES
    )
    return f"WITH {PROF}, known AS (SELECT * FROM prof WHERE label IS NOT NULL) SELECT user_id, {cols} FROM known WINDOW {windows}"


def _ordered_encode() -> str:
    """Run the expanding statistic per training and keep each category's last value."""
    ctes, cols, joins = [], [], []
    for c in CATEGORIES:
        ctes.append(
            f"""e_{c} AS (SELECT t, {c} AS v, user_id,
              (coalesce(sum(label) OVER w, 0) + p) / (count(label) OVER w + 1) AS code
              FROM (SELECT prof.*, t, s * 1.0 / n AS p FROM prof JOIN tot ON fold <> t WHERE label IS NOT NULL)
              WHERE {c} IS NOT NULL
              WINDOW w AS (PARTITION BY t, {c} ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            l_{c} AS (SELECT t, v, arg_max(code, user_id) AS code FROM e_{c} GROUP BY t, v)"""
        )
        cols.append(f"{r(f'coalesce(l_{c}.code, tot.s * 1.0 / tot.n)')} AS {c}_cat_enc")
        joins.append(f"LEFT JOIN l_{c} ON l_{c}.v = prof.{c} AND l_{c}.t = coalesce(fold, -1)")
    return f"""WITH {TRAIN}, {', '.join(ctes)} SELECT prof.user_id, {', '.join(cols)} FROM prof
      JOIN tot ON tot.t = coalesce(fold, -1) {' '.join(joins)}"""


EVENT_FEATURES = ("ip", "k7", "event_type")


def _event_codes(features: Iterable[str], user_mean: bool, code: str = MEAN_CODE) -> str:
    """One code table per feature and training, from all events of the other folds' users."""
    ctes = [
        PROF,
        ACT,
        "trainings AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS t)",
        "ev AS (SELECT act.*, label, fold FROM act JOIN prof USING (user_id))",
        "tot AS (SELECT t, sum(label) AS s, count(label) AS n FROM ev, trainings WHERE label IS NOT NULL AND fold <> t GROUP BY t)",
    ]
    for c in features:
        source = f"SELECT DISTINCT user_id, label, fold, {c} FROM ev" if user_mean else "SELECT * FROM ev"
        ctes.append(
            f"""g_{c} AS (SELECT t, v, {code} AS code FROM (SELECT t, {c} AS v, sum(label) AS s0, count(label) AS n0
              FROM ({source}), trainings WHERE label IS NOT NULL AND fold <> t AND {c} IS NOT NULL GROUP BY t, {c})
              JOIN tot USING (t))"""
        )
    joins = " ".join(f"LEFT JOIN g_{c} ON g_{c}.v = ev.{c} AND g_{c}.t = coalesce(ev.fold, -1)" for c in features)
    codes = ", ".join(f"g_{c}.code AS {c}_te" for c in features)
    ctes.append(f"coded AS (SELECT ev.seq, ev.user_id, coalesce(ev.fold, -1) AS t, {codes} FROM ev {joins})")
    return ",\n".join(ctes)


def _event_stats() -> str:
    cols = []
    for c in EVENT_FEATURES:
        for kind in SPREAD:
            e = stat(kind, f"{c}_te")
            if kind == "sum":
                e = f"coalesce({e}, 0)"
            cols.append(f"{e if kind in ('mean', 'std', 'median') else r(e)} AS {c}_te_{kind}")
    return f"WITH {_event_codes(EVENT_FEATURES, False)} SELECT user_id, {', '.join(cols)} FROM coded GROUP BY 1"


def _event_means(user_mean: bool) -> str:
    cols = ", ".join(f"{r(f'avg({c}_te)')} AS {c}_te_mean" for c in EVENT_FEATURES)
    return f"WITH {_event_codes(EVENT_FEATURES, user_mean)} SELECT user_id, {cols} FROM coded GROUP BY 1"


def _event_encoders() -> str:
    parts = {}
    for name, code in (("me", ME_CODE), ("js", JS_CODE)):
        cols = ", ".join(
            f"{r(f'avg(coalesce({c}_te, tot.s * 1.0 / tot.n))')} AS {c}_{name}_mean" for c in ("ip", "k7")
        )
        parts[name] = f"""(WITH {_event_codes(('ip', 'k7'), False, code)}
          SELECT user_id, {cols} FROM coded JOIN tot USING (t) GROUP BY 1)"""
    return f"SELECT * FROM {parts['me']} a JOIN {parts['js']} b USING (user_id)"


SMOOTH_WOE_CODE = "CASE WHEN n0 > 1 THEN ln(((s0 + 1.0) / (s + 2.0)) / ((n0 - s0 + 1.0) / (n - s + 2.0))) ELSE 0.0 END"
LOO_CODE = "CASE WHEN n0 > 1 THEN s0 * 1.0 / n0 END"


def _event_transforms() -> str:
    parts = []
    for name, code, unseen in (
        ("woe", SMOOTH_WOE_CODE, "0.0"), ("loo", LOO_CODE, "tot.s * 1.0 / tot.n"), ("cbt", ME_CODE, "tot.s * 1.0 / tot.n"),
    ):
        cols = ", ".join(f"{r(f'avg(coalesce({c}_te, {unseen}))')} AS {c}_{name}_mean" for c in ("ip", "k7"))
        parts.append(
            f"""(WITH {_event_codes(('ip', 'k7'), False, code)}
          SELECT user_id, {cols} FROM coded JOIN tot USING (t) GROUP BY 1)"""
        )
    return f"SELECT * FROM {parts[0]} a JOIN {parts[1]} b USING (user_id) JOIN {parts[2]} c USING (user_id)"


FILES = f"""WITH {ACT}, trans AS (
  SELECT user_id, count(*) AS n_trans, sum(amount) AS amount_sum FROM act WHERE property = 'trans' GROUP BY 1),
op AS (SELECT user_id, count(*) AS n_op, max(timestamp) AS last_op FROM act WHERE property = 'op' GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS user, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_acctbal < 0 AS BIGINT) END AS label,
  c_mktsegment AS sex, CAST(c_nationkey AS BIGINT) AS province,
  CASE WHEN c_custkey % 7 > 0 THEN CAST(c_custkey % 90 + 0.5 AS DOUBLE) END AS age,
  CASE WHEN c_custkey % 3 > 0 THEN 'level ' || c_custkey % 20 END AS balance,
  n_trans, {r('amount_sum')} AS amount_sum, n_op, last_op
FROM customer LEFT JOIN trans ON trans.user_id = c_custkey LEFT JOIN op ON op.user_id = c_custkey"""


TOP = (
    ACT
    + """, top AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY timestamp, rank, seq) AS pos,
  event_type, coalesce(k7, '0') AS k7, ip, CAST(hour AS DOUBLE) AS hour FROM act
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp, rank, seq) <= 50)"""
)


def _appearance(column: str) -> str:
    return f"""c_{column} AS (SELECT v, row_number() OVER (ORDER BY u, p) AS code FROM (
      SELECT {column} AS v, min(user_id) AS u, arg_min(pos, (user_id, pos)) AS p FROM top GROUP BY 1))"""


def _tfidf(tokens: str, key: str, documents: str) -> str:
    return f"""{tokens}, df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
      w AS (SELECT {key}, term, tf * (ln((1.0 + ({documents})) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term))
      SELECT {key}, term, {r(f'w / sqrt(sum(w * w) OVER (PARTITION BY {key}))')} AS weight FROM w"""


RUNS = (
    (7919, "gbt", 2020, "without_behaviour"),
    (104729, "gbt", 2020, "all"),
    (1299709, "gbt", 779, "without_behaviour"),
    (15485863, "gbt", 2020, "without_crosses"),
    (32452843, "gbt", 779, "without_crosses"),
    (49979687, "nn", 1997, "all"),
)
SCORES = f"{PROF}, scores AS ({' UNION ALL '.join(f'''SELECT user_id, label, fold,
  CASE WHEN label IS NULL THEN 'test' ELSE 'oof' END AS split, '{m}' AS model, {seed} AS seed,
  '{fs}' AS feature_set, (user_id * {factor}) % 1000 / 1000.0 AS score FROM prof''' for factor, m, seed, fs in RUNS)})"


def _auc(source: str, keys: str) -> str:
    """AUC as the share of (bad, good) pairs in the right order, from mid-ranks."""
    group = f"{keys}, " if keys else ""
    by = f"PARTITION BY {keys} " if keys else ""
    tail = f"GROUP BY {keys}" if keys else ""
    return f"""ranked AS (SELECT {group}label, rank() OVER ({by}ORDER BY score)
        + (count(*) OVER (PARTITION BY {group}score) - 1) / 2.0 AS rk FROM ({source}) WHERE label IS NOT NULL),
      auc AS (SELECT {group}CAST(sum(label) AS BIGINT) AS n_bad, CAST(sum(1 - label) AS BIGINT) AS n_good,
        (CAST(sum(CASE WHEN label = 1 THEN rk END) AS DOUBLE) - sum(label) * (sum(label) + 1) / 2.0)
        / nullif(sum(label) * sum(1 - label), 0) AS auc FROM ranked {tail})"""


def _blend() -> str:
    families = []
    for name, members in BLEND_FAMILIES.items():
        terms = " ".join(
            f"WHEN model = '{m.model}' AND seed = {m.seed} AND feature_set = '{m.feature_set}' THEN {m.weight}" for m in members
        )
        families.append(f"sum(CAST(score AS DOUBLE) * CASE {terms} END) AS \"{name}\"")
    total = " + ".join(
        f'{w} * ("{n}" - min("{n}") OVER (PARTITION BY split)) / max("{n}") OVER (PARTITION BY split)'
        for n, w in BLEND_WEIGHTS.items()
    )
    return f"""{SCORES}, wide AS (SELECT user_id, split, {', '.join(families)} FROM scores GROUP BY 1, 2),
      blend AS (SELECT *, {total} AS blend FROM wide)"""


FIRST_LAST = f"""WITH {ACT}, o AS (SELECT *,
            row_number() OVER (PARTITION BY user_id ORDER BY timestamp, rank, seq) AS a,
            row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, rank DESC, seq DESC) AS z,
            row_number() OVER (PARTITION BY user_id, property ORDER BY timestamp, seq) AS pa,
            row_number() OVER (PARTITION BY user_id, property ORDER BY timestamp DESC, seq DESC) AS pz FROM act)
            SELECT user_id, max(property) FILTER (WHERE z = 1) AS last_behaviour,
            max(property) FILTER (WHERE a = 1) AS first_behaviour, {', '.join(
            f"max({c}) FILTER (WHERE {'pz' if e == 'last' else 'pa'} = 1 AND property = 'trans') AS {e}_{n}_trans"
            for n, c in (('days_diff', 'days_diff'), ('hour', 'hour'), ('week', 'week'), ('time', 'timestamp'))
            for e in ('last', 'first'))} FROM o GROUP BY 1"""
SESSION_COUNTS = f"""WITH {SESS} SELECT user_id,
            CAST(max(CASE WHEN property = 'trans' THEN 1 ELSE 0 END) AS BIGINT) AS has_trans,
            count(DISTINCT CASE WHEN property = 'trans' THEN session END) AS trans_count,
            count(DISTINCT CASE WHEN property = 'op' THEN session END) AS op_count FROM sess GROUP BY 1"""


def _file_types() -> str:
    """The declared type of every column of the seven files, with counts from the tables."""
    base = {"user": "long", "sex": "string", "province": "double", "age": "double", "balance": "string"}
    trans = {"user": "long", "ip": "long", "ip_3": "long", "amount": "double", "tm_diff": "string"}
    op = {"user": "long", "op_type": "string", "ip": "long", "ip_3": "long", "tm_diff": "string"}
    parts = []
    for train in (True, False):
        of = "<>" if train else "="
        person = f"""SELECT c_custkey AS "user", c_mktsegment AS sex, c_nationkey AS province,
          CASE WHEN c_custkey % 7 > 0 THEN 0.5 END AS age, CASE WHEN c_custkey % 3 > 0 THEN 'level' END AS balance
          FROM customer WHERE c_custkey % 5 {of} 0"""
        event = f"""SELECT user_id AS "user", event_type AS op_type, ip, ip_3, amount, 'd' AS tm_diff FROM act
          WHERE user_id % 5 {of} 0 AND property = """
        front = "train/train" if train else "test/testb"
        sources = [(f"{front}_base", person, base), (f"{front}_trans", event + "'trans'", trans), (f"{front}_op", event + "'op'", op)]
        if train:
            label = 'SELECT c_custkey AS "user", 0 AS label FROM customer WHERE c_custkey % 5 <> 0'
            sources.append(("train/train_label", label, {"user": "long", "label": "double"}))
        for name, sql, columns in sources:
            for c, kind in columns.items():
                there = f'count("{c}")'
                parts.append(
                    f"""SELECT '{name}' AS file, '{c}' AS "column", '{kind}' AS kind, count(*) AS n_rows, count(*) - {there} AS n_missing,
                    {there if kind == 'long' else '0'} AS n_whole, {there if kind != 'string' else '0'} AS n_number,
                    {there if c == 'age' else '0'} AS n_rejects FROM ({sql})"""
                )
    return f"WITH {ACT} {' UNION ALL '.join(parts)}"


def _matrix() -> str:
    """The blocks, each in the SQL of its own query, side by side."""
    numbers = ["nation", "n_orders", "n_open", "last_day"]
    names = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in numbers)
    status = ", ".join(stats("amount", ("count", "mean"), f"status_{v}", f"status = '{v}'") for v in ("F", "O", "P"))
    behaviour = FIRST_LAST.replace("max(property) FILTER", "max(CAST(property = 'trans' AS BIGINT)) FILTER")
    popular = _popularity_users(("ip", "k7"))
    popular_names = ", ".join(f"log_{c}_user_nuniq_{k}" for c in ("ip", "k7") for k in ("mean", "max"))
    codes = ", ".join(f"{c}_te_{k}" for c in ("ip", "event_type") for k in ("mean", "max"))
    blocks = [
        f"""WITH {NUM}, s AS (SELECT user_id, {_scaled(numbers)} FROM num), x AS (SELECT user_id, {_crosses(numbers)} FROM s)
          SELECT user_id, {names}, x.* EXCLUDE (user_id) FROM num JOIN x USING (user_id)""",
        f"WITH {COM} SELECT user_id, {stats('amount', BASIC, 'order_amount')}, {status} FROM com GROUP BY 1",
        f"""WITH {PUR} SELECT user_id, {stats('amount', BASIC, 'amount')}, min(days_diff) AS early_day,
          max(days_diff) AS max_day, {_calendar()} FROM pur GROUP BY 1""",
        f"""SELECT *, {r('trans_count * 1.0 / nullif(op_count, 0)')} AS trans_ratio
          FROM ({behaviour}) JOIN ({SESSION_COUNTS}) USING (user_id)""",
        f"SELECT user_id, {popular_names} FROM ({popular})",
        _refits(MEAN_CODE, "prior", "oof_mean"),
        f"SELECT user_id, {codes} FROM ({_event_stats()})",
    ]
    joins = " ".join(f"LEFT JOIN ({sql}) b{i} USING (user_id)" for i, sql in enumerate(blocks))
    return f"SELECT * FROM (WITH {PROF} SELECT user_id, label, fold FROM prof) e {joins}"


def oracle() -> dict[str, str]:
    numbers = ["nation", "n_orders", "n_open", "last_day"]
    amount_to = ("status_n", "priority", "week")
    sql = {
        "user_amount_stats": f"WITH {COM} SELECT user_id, {stats('amount', BASIC, 'amount')} FROM com GROUP BY 1",
        "amount_rate_stats": f"""WITH {PUR}, nxt AS (SELECT user_id,
            CAST(amount - lead(amount) OVER w AS DOUBLE) AS da, timestamp - lead(timestamp) OVER w AS dt
            FROM pur WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, seq)),
            rates AS (SELECT user_id, da / CASE WHEN dt = 0 THEN 0.01 ELSE CAST(dt AS DOUBLE) END AS x FROM nxt)
            SELECT user_id, {stats('x', BASIC, 'amount_diff')} FROM rates GROUP BY 1""",
        "trailing_day_stats": f"WITH {PUR} SELECT user_id, {_trailing()} FROM pur GROUP BY 1",
        "cube_trailing_day_stats": f"WITH {PUR} SELECT user_id, {_cube_trailing()} FROM pur GROUP BY 1",
        "cube_hour_range_stats": f"WITH {PUR} SELECT user_id, {_cube_hours()} FROM pur GROUP BY 1",
        "cube_calendar_counts": f"""WITH {PUR} SELECT user_id, {_cube_calendar()}, min(timestamp) AS first_time,
            max(timestamp) AS last_time FROM pur GROUP BY 1""",
        "sketch_distinct_counts": f"""WITH {ACT} {' UNION ALL '.join(
            f"SELECT property, '{c}' AS field, count(DISTINCT {c}) AS n, CAST(1 AS BIGINT) AS within FROM act GROUP BY 1"
            for c in ('user_id', 'ip', 'ip_3', 'k7'))}""",
        "sketch_medians": f"""WITH {ACT} SELECT property, week, count(amount) AS n, CAST(1 AS BIGINT) AS within
            FROM act GROUP BY 1, 2""",
        "sketch_shared_values": f"WITH {ACT} {_shared_values(('user_id', 'ip', 'k7'))}",
        "sparse_one_hot": f"""WITH {PROF}, named AS (
              SELECT user_id, 'nation_segment' AS field, nation_segment AS v FROM prof
              UNION ALL SELECT user_id, 'segment_n', segment_n FROM prof),
            ids AS (SELECT field, v, dense_rank() OVER (ORDER BY field, v) - 1 AS id FROM
              (SELECT DISTINCT field, v FROM named WHERE v IS NOT NULL))
            SELECT user_id, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id), '') AS ids
            FROM named LEFT JOIN ids USING (field, v) GROUP BY 1""",
        "sparse_pivot": f"""WITH {COM} SELECT user_id, days_diff || '/' || status AS day_status, count(amount) AS amount_count,
            {r('sum(amount)')} AS amount_sum, {r('max(amount)')} AS amount_max FROM com GROUP BY 1, 2""",
        "hour_range_stats": f"WITH {PUR} SELECT user_id, {_hours()} FROM pur GROUP BY 1",
        "session_amount_stats": f"""WITH {PSESS} SELECT user_id, {', '.join(
            stats('amount', WITH_STD, 'amount', f'session = {n}', f'_session{n}', null=True) for n in (0, 1))}
            FROM sess GROUP BY 1""",
        "user_nunique": f"""WITH {COM} SELECT user_id, {', '.join(
            f'count(DISTINCT {c}) AS trans_{c}_nuniq' for c in ('days_diff', 'status', 'priority', 'status_n', 'week'))}
            FROM com GROUP BY 1""",
        "user_null_stats": f"""WITH {ACT} SELECT user_id, {', '.join(
            f"count(*) - count({c}) AS {c}_null_cnt, {r(f'1 - count({c}) * 1.0 / count(*)')} AS {c}_null_ratio"
            for c in ('k7', 'ip'))} FROM act GROUP BY 1""",
        "user_nonnull_count": f"""WITH {ACT} SELECT user_id, count(k7) AS k7_cnt, count(ip) AS ip_cnt,
            count(amount) AS amount_cnt FROM act GROUP BY 1""",
        "typed_time_stats": f"""WITH {COM} SELECT user_id, {', '.join([
            stats('days_diff', SPREAD, 'priority_urgent_days_diff', "priority = '1-URGENT'", money=False),
            stats('days_diff', SPREAD, 'priority_low_days_diff', "priority = '5-LOW'", money=False),
            stats('week', SPREAD, 'status_F_week', "status = 'F'", money=False)])} FROM com GROUP BY 1""",
        "pivot_amount_by_category": f"WITH {COM} SELECT user_id, {_pivot('com', 'status', 'FOP', 'amount', True)} FROM com GROUP BY 1",
        "pivot_property_days": f"""WITH {ACT} SELECT *, {r('''property_trans_days_diff_count * 1.0
            / nullif(property_op_days_diff_count, 0)''')} AS op_trans_ratio FROM (SELECT user_id,
            {_pivot('act', 'property', ('trans', 'op'), 'days_diff', False)} FROM act GROUP BY 1)""",
        "value_user_popularity": _popularity_rows(("ip", "k7", "hour")),
        "popularity_user_stats": _popularity_users(("ip", "k7")),
        "group_amount_to_rows": f"""WITH {COM} SELECT seq, {', '.join(
            f'''CASE WHEN {c} IS NOT NULL THEN {r(f"CAST(sum(amount) OVER (PARTITION BY {c}) AS DOUBLE) / count(amount) OVER (PARTITION BY {c})")}
            END AS amount_to_mean_{c}, CASE WHEN {c} IS NOT NULL THEN
            {r(f"stddev_samp(CAST(amount AS DOUBLE)) OVER (PARTITION BY {c})", 4)} END AS amount_to_std_{c}'''
            for c in amount_to)} FROM com""",
        "amount_deviation": f"""WITH {COM}, dev AS (SELECT user_id, {', '.join(
            f"CAST(sum(amount) OVER (PARTITION BY {c}) AS DOUBLE) / count(*) OVER (PARTITION BY {c}) - CAST(amount AS DOUBLE) AS x_{c}"
            for c in ('status', 'priority'))} FROM com) SELECT user_id, {', '.join(
            stats(f'x_{c}', ('mean', 'std', 'max', 'min'), f'{c}_amt_sub_rt') for c in ('status', 'priority'))}
            FROM dev GROUP BY 1""",
        "mode_frequency": f"""WITH {ACT}, a AS (SELECT ip, k7, count(*) AS n FROM act WHERE k7 IS NOT NULL GROUP BY 1, 2),
            b AS (SELECT ip, event_type, count(*) AS n FROM act WHERE property = 'op' GROUP BY 1, 2)
            SELECT ip, (SELECT max(n) FROM a WHERE a.ip = i.ip) AS k7_mode_count, CAST(NULL AS BIGINT) AS event_type_mode_count
            FROM (SELECT DISTINCT ip FROM act) i
            UNION ALL SELECT ip, NULL, max(n) FROM b GROUP BY 1""",
        "value_lifespan": _lifespan("ip", "ip"),
        "value_pair_lifespan": _lifespan("ip,k7", "ip_k7"),
        "shared_resource_stats": _shared({"l_suppkey": "l_suppkey", "l_partkey": "l_partkey"}),
        "shared_resource_pair_stats": _shared({"l_suppkey_l_partkey": "l_suppkey || '_' || l_partkey"}),
        "weekday_daypart_counts": f"""WITH {PUR} SELECT user_id, min(days_diff) AS early_day, max(days_diff) AS max_day,
            {_calendar()}, {r('max(amount)')} AS amount_max, {r('min(amount)')} AS amount_min,
            max(days_diff) - min(days_diff) AS range_day, {r('max(amount) - min(amount)')} AS amount_range
            FROM pur GROUP BY 1""",
        "hour_share": f"""WITH {PUR} SELECT user_id, {', '.join(
            f"{r(f'count(*) FILTER (WHERE hour > {a} AND hour <= {b}) * 1.0 / count(*)')} AS hour_{a}_{b}_ratio"
            for a, b in ((0, 6), (6, 12), (12, 18), (18, 24)))} FROM pur GROUP BY 1""",
        "weekend_share": f"""WITH {PUR} SELECT user_id,
            {r('count(*) FILTER (WHERE week IN (0, 6)) * 1.0 / count(*)')} AS weekend_ratio FROM pur GROUP BY 1""",
        "log_union": f"""WITH {ACT} SELECT user_id, seq, ip, ip_3, k7, event_type, {r('amount')} AS amount,
            CAST(days_diff AS BIGINT) AS days_diff, hour, CAST(week AS BIGINT) AS week, timestamp, property FROM act""",
        "relative_time_parse": """SELECT event_id, d || ' days ' || strftime(ts, '%H:%M:%S.%f') || '000' AS tm_diff,
            CAST(d AS BIGINT) AS days_diff, hour(ts) AS hour, CAST(d % 7 AS BIGINT) AS week,
            CAST(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS BIGINT) AS timestamp
            FROM (SELECT *, CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS BIGINT) AS d FROM events)""",
        "composite_keys": f"""WITH {ACT} SELECT seq, event_type || '_' || coalesce(k7, 'nan') AS event_type_k7,
            week || '_' || property AS week_property, days_diff || '_' || hour || '_' || property AS day_hour_property,
            coalesce(k7, 'nan') || '_' || amount AS k7_amount FROM act""",
        "sessionize": f"WITH {SESS} SELECT seq, user_id, property, timestamp, session FROM sess",
        "session_summary": f"""WITH {SESS} SELECT user_id, session, min(timestamp) AS session_start,
            max(timestamp) AS session_end, count(*) AS n_rows FROM sess GROUP BY 1, 2""",
        "session_gap_mean": f"""WITH {SESS}, ends AS (SELECT user_id, session, max(timestamp) AS e FROM sess GROUP BY 1, 2),
            gap AS (SELECT user_id, e - coalesce(lag(e) OVER (PARTITION BY user_id ORDER BY session), 0) AS g FROM ends)
            SELECT user_id, {r('CAST(sum(g) AS DOUBLE) / count(*)')} AS session_time_delta FROM gap GROUP BY 1""",
        "time_to_next": f"""WITH {ACT} SELECT seq, timestamp - lead(timestamp) OVER w AS time_diff,
            {r('amount - lead(amount) OVER w')} AS amount_diff FROM act
            WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, rank, seq)""",
        "first_last_behaviour": FIRST_LAST,
        "has_and_session_counts": SESSION_COUNTS,
        "resource_overlap": f"""WITH {ACT} SELECT user_id, {', '.join(
            f'''CAST(EXISTS (SELECT 1 FROM act a JOIN act b ON a.user_id = b.user_id AND a.{c} = b.{c}
            WHERE a.user_id = u.user_id AND a.property = 'trans' AND b.property = 'op') AS BIGINT) AS if_{c}_same'''
            for c in ('ip', 'k7'))} FROM (SELECT DISTINCT user_id FROM act) u""",
        "frequency_encode": f"""WITH {PROF} SELECT user_id, count(*) OVER (PARTITION BY nation) AS nation_count,
            count(*) OVER (PARTITION BY segment) AS segment_count,
            CASE WHEN segment_n IS NOT NULL THEN count(*) OVER (PARTITION BY segment_n) END AS segment_n_count FROM prof""",
        "minmax_scale": f"""WITH {NUM} SELECT user_id, {', '.join(
            f'''{r(f"CAST({c} - min({c}) OVER () AS DOUBLE) / max({c}) OVER ()")} AS {c},
            {r(f"CAST({c} - min({c}) OVER () AS DOUBLE) / (max({c}) OVER () - min({c}) OVER ())")} AS {c}_range'''
            for c in ('nation', 'n_orders', 'last_day'))} FROM num""",
        "pairwise_cross": f"""WITH {NUM}, s AS (SELECT user_id, {_scaled(numbers)},
            n_open * 1.0 / nullif(n_orders, 0) AS open_ratio FROM num)
            SELECT user_id, {_crosses(numbers)}, {r('open_ratio')} AS open_ratio FROM s""",
        "one_vs_rest_bits": f"""WITH {PROF}, f AS (SELECT user_id, {', '.join(
            f'CAST(nation = {v} AS BIGINT) AS is_{v}_nation' for v in (21, 6, 3, 20, 16))} FROM prof),
            b AS (SELECT *, {' || '.join(f'is_{v}_nation' for v in (21, 6, 3, 20, 16))} AS binary_nation FROM f)
            SELECT *, dense_rank() OVER (ORDER BY binary_nation) - 1 AS binary_nation_code FROM b""",
        "ordinal_parse": """SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS priority,
            CASE WHEN o_orderpriority = '5-LOW' THEN -1 ELSE CAST(left(o_orderpriority, 1) AS BIGINT) END AS priority_n
            FROM orders""",
        "equal_width_bins": f"""WITH {COM}, m AS (SELECT min(days_diff) AS d0, max(days_diff) AS d1,
            CAST(min(amount) AS DOUBLE) AS a0, CAST(max(amount) AS DOUBLE) AS a1 FROM com)
            SELECT seq, CAST(least(floor((days_diff - d0) / ((d1 - d0) / 10.0)), 9) AS BIGINT) AS days_diff_bin,
            CAST(least(floor((CAST(amount AS DOUBLE) - a0) / ((a1 - a0) / 10)), 9) AS BIGINT) AS amount_bin FROM com, m""",
        "zscore": f"""WITH {NUM} SELECT user_id, {', '.join(
            f"{r(f'({c} - avg({c}) OVER ()) / stddev_samp(CAST({c} AS DOUBLE)) OVER ()', 4)} AS {c}"
            for c in ('nation', 'n_orders', 'n_open'))} FROM num""",
        "one_hot": f"""WITH {PROF}, c AS (SELECT DISTINCT segment AS v FROM prof) SELECT user_id, {', '.join(
            f'CAST(segment = (SELECT v FROM c ORDER BY v LIMIT 1 OFFSET {i}) AS BIGINT) AS oh_enc{i}' for i in range(5))}
            FROM prof""",
        "mean_fill": f"""WITH {NUM}, h AS (SELECT user_id, nullif(n_open, 3) AS n_open,
            CASE WHEN nation > 4 THEN nation END AS nation FROM num) SELECT user_id,
            {r('coalesce(n_open, (SELECT avg(n_open) FROM h))')} AS n_open,
            {r('coalesce(nation, (SELECT avg(nation) FROM h))')} AS nation FROM h""",
        "const_fill": f"""WITH {PROF} SELECT user_id, coalesce(label, -999) AS label,
            coalesce(segment_n, '-1') AS segment_n FROM prof""",
        "label_encode": f"""WITH {PROF} SELECT user_id, {', '.join(
            f"dense_rank() OVER (ORDER BY coalesce({c}, '-1')) - 1 AS {c}" for c in ('segment', 'segment_n', 'nation_segment'))}
            FROM prof""",
        "factorize": f"""WITH {PROF}, {', '.join(
            f'''f_{c} AS (SELECT {c}, row_number() OVER (ORDER BY min(user_id)) - 1 AS code FROM prof
            WHERE {c} IS NOT NULL GROUP BY 1)''' for c in ('segment_n', 'nation_segment'))}
            SELECT user_id, coalesce(f_segment_n.code, -1) AS segment_n_code,
            coalesce(f_nation_segment.code, -1) AS nation_segment_code FROM prof
            LEFT JOIN f_segment_n USING (segment_n) LEFT JOIN f_nation_segment USING (nation_segment)""",
        "column_profile": f"""WITH {COM} {' UNION ALL '.join(
            f'''SELECT '{c}' AS "column", '{k}' AS kind, count(DISTINCT {c}) AS n_unique,
            CAST(count(DISTINCT {c}) < 1000 AS BIGINT) AS below_1000 FROM com'''
            for c, k in (('amount', 'dense'), ('days_diff', 'sparse'), ('week', 'sparse'), ('user_id', 'sparse')))}""",
        "bad_rate_topk": f"""WITH {PROF} SELECT CAST(nation AS BIGINT) AS nation, count(label) AS total,
            CAST(sum(label) AS BIGINT) AS bad, {r('sum(label) * 1.0 / count(label)')} AS bad_rate FROM prof GROUP BY 1
            ORDER BY sum(label) * 1.0 / count(label) DESC NULLS LAST, nation LIMIT 5""",
        "stratified_folds": f"""WITH {PROF} SELECT user_id, label, fold AS hash_fold, CASE WHEN label IS NOT NULL THEN
            (row_number() OVER (PARTITION BY label ORDER BY md5('2020:' || CAST(user_id AS VARCHAR)), user_id) - 1) % 5
            END AS fold FROM prof""",
        "oof_mean_encode": _refits(MEAN_CODE, "prior", "oof_mean"),
        "oof_mean_encode_selffill": _refits(MEAN_CODE, "own_mean", "oof_mean"),
        "woe_encode": _refits(WOE_CODE, "category_mean", "woe", 4),
        "woe_table": f"""WITH {PROF}, t AS (SELECT sum(label) AS s, count(label) AS n FROM prof),
            g AS (SELECT segment_n, sum(label) AS s0, count(label) AS n0 FROM prof
              WHERE label IS NOT NULL AND segment_n IS NOT NULL GROUP BY 1)
            SELECT segment_n, CAST(s0 AS BIGINT) AS bad, n0 AS n, {r(WOE_CODE, 4)} AS woe FROM g, t""",
        "m_estimate": _refits(ME_CODE, "prior", "me"),
        "james_stein": _refits(JS_CODE, "prior", "js"),
        "leave_one_out": _leave_one_out(),
        "leave_one_out_folds": _refits(LOO_CODE, "prior", "loo"),
        "ordered_target": _ordered_rows(),
        "ordered_target_encode": _ordered_encode(),
        "event_target_encode": _event_stats(),
        "event_target_encode_usermean": _event_means(True),
        "event_target_encode_rows": f"""WITH {_event_codes(EVENT_FEATURES, False)} SELECT seq, user_id, {', '.join(
            f"{r(f'{c}_te')} AS {c}_te" for c in EVENT_FEATURES)} FROM coded""",
        "event_category_encoders": _event_encoders(),
        "event_transform_encoders": _event_transforms(),
        "files_to_input": FILES,
        "feature_matrix_build": _matrix(),
        "score_table_rerun": f"""WITH {PROF}, u AS (SELECT CASE WHEN label IS NULL THEN 'test' ELSE 'oof' END AS split,
              count(*) AS n FROM prof GROUP BY 1),
            runs AS (SELECT unnest(['gbt/2020/without_behaviour', 'gbt/2020/all', 'gbt/779/without_behaviour',
              'gbt/2020/without_crosses', 'gbt/779/without_crosses', 'nn/1997/all']) AS part)
            SELECT part, split, n AS n_rows, n AS n_users FROM runs, u
            UNION ALL SELECT 'trees', split, 5 * n, n FROM u
            UNION ALL SELECT unnest(['single', 'averaged', 'blended']), split, n, n FROM u WHERE split = 'test'""",
        "file_types": _file_types(),
        "best_rounds": f"""WITH {PROF} SELECT fold, CAST(sum(label) AS BIGINT) AS n_bad, CAST(sum(1 - label) AS BIGINT) AS n_good,
            CAST(1 AS BIGINT) AS inside, CAST(1 AS BIGINT) AS same_auc FROM prof WHERE label IS NOT NULL GROUP BY fold""",
        "fold_score_contract": f"""WITH {PROF} SELECT user_id, CASE WHEN label IS NULL THEN 'test' ELSE 'oof' END AS split,
            CAST(CASE WHEN label IS NULL THEN 5 ELSE 1 END AS BIGINT) AS n_models, CAST(0 AS BIGINT) AS off,
            CAST(1 AS BIGINT) AS in_range FROM prof""",
        "user_sequences": f"""WITH {TOP}, {_appearance('event_type')}, {_appearance('k7')},
            m AS (SELECT avg(hour) AS a, stddev_samp(hour) AS s FROM top)
            SELECT user_id, string_agg(c_event_type.code, ',' ORDER BY pos) AS event_type,
            string_agg(c_k7.code, ',' ORDER BY pos) AS k7,
            string_agg(CAST(round((hour - a) / s * 1000) AS BIGINT), ',' ORDER BY pos) AS hour_milli
            FROM top JOIN c_event_type ON c_event_type.v = event_type JOIN c_k7 ON c_k7.v = k7, m GROUP BY 1""",
        "padded_sequences": f"""WITH {TOP}, {_appearance('event_type')}, {PROF},
            l AS (SELECT user_id, list(c_event_type.code ORDER BY pos) AS codes FROM top
              JOIN c_event_type ON v = event_type GROUP BY 1),
            x AS (SELECT prof.user_id, coalesce(codes, [0]) AS codes FROM prof LEFT JOIN l USING (user_id))
            SELECT user_id, array_to_string(list_resize(codes, (SELECT max(len(codes)) FROM x), 0), ',') AS event_type,
            CAST(len(codes) AS BIGINT) AS seq_len FROM x""",
        "sequence_vocabulary": f"""WITH {TOP} {' UNION ALL '.join(
            f'''SELECT '{c}' AS "column", count(DISTINCT {c}) + 1 AS vocabulary FROM top''' for c in ('event_type', 'k7', 'ip'))}""",
        "value_neighbour_counts": f"""WITH {ACT}, placed AS (SELECT user_id, coalesce(ip, 'nan') AS v,
              row_number() OVER (PARTITION BY user_id ORDER BY timestamp, rank, seq) AS pos FROM act WHERE user_id IS NOT NULL),
            near AS (SELECT a.v AS one, b.v AS other, 11 - (b.pos - a.pos) AS tenths FROM placed a JOIN placed b
              ON a.user_id = b.user_id AND b.pos > a.pos AND b.pos <= a.pos + 10),
            c AS (SELECT value, term, sum(n) / 10.0 AS weight FROM (SELECT one AS value, other AS term, tenths AS n FROM near
              UNION ALL SELECT other, one, tenths FROM near) GROUP BY ALL),
            s AS (SELECT value, sum(weight) AS w FROM c GROUP BY 1),
            t AS (SELECT sum(pow(w, 0.75)) AS whole FROM s),
            i AS (SELECT c.value, c.term, c.weight, ln(c.weight / (a.w * pow(b.w, 0.75) / whole)) AS x
              FROM c JOIN s a ON a.value = c.value JOIN s b ON b.value = c.term, t)
            SELECT value, term, {r("weight")} AS weight, {r("CASE WHEN x > 0 THEN x END")} AS information FROM i""",
        "svd_certificate": """SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, CAST(1 AS BIGINT) AS holds,
            CAST(1 AS BIGINT) AS converged FROM range(10) a(i), range(10) b(j) WHERE j <= i""",
        "tfidf_weights": "WITH "
        + _tfidf(
            r"""tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id,
            unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents) GROUP BY 1, 2)""",
            "doc_id",
            "SELECT count(*) FROM documents",
        ),
        "user_tfidf_weights": f"WITH {ACT}, "
        + _tfidf(
            "tf AS (SELECT user_id, event_type || '_' || ip AS term, count(*) AS tf FROM act GROUP BY 1, 2)",
            "user_id",
            "SELECT count(DISTINCT user_id) FROM act",
        ),
        "roc_auc": f"""WITH {SCORES}, {_auc('SELECT * FROM scores', 'model, seed, feature_set')}
            SELECT model, CAST(seed AS BIGINT) AS seed, feature_set, n_bad, n_good, {r('auc')} AS auc FROM auc""",
        "fold_auc_summary": f"""WITH {SCORES}, {_auc("SELECT * FROM scores WHERE model = 'gbt' AND feature_set = 'all'", 'fold')}
            SELECT {r('avg(auc)')} AS auc_mean, {r('stddev_pop(auc)', 4)} AS auc_std FROM auc""",
        "blend_scores": f"""WITH {_blend()} SELECT user_id, split, {', '.join(f'{r(n)} AS {n}' for n in ('"full"', 'lean', 'sequence'))},
            {r('blend')} AS blend FROM blend""",
        "blended_auc": f"""WITH {_blend()}, {_auc('''SELECT label, round(blend, 9) AS score FROM blend JOIN prof USING (user_id)
            WHERE split = 'oof' ''', '')} SELECT n_bad, n_good, {r('auc')} AS auc FROM auc""",
    }
    return sql
