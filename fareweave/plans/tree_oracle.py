"""SQL twins of the boosted trees: one split after the other, each found by a scan of all rows and cut points."""

from __future__ import annotations

FEW_FEATURES = [
    "hour_of_day", "day_of_week", "passenger_demand", "driver_availability", "weather_severity_score", "base_fare",
]
SCALE = "1099511627776.0::DOUBLE"  # 2 to the power of 40
BINS, ROUNDS, RATE = 16, 3, "0.3::DOUBLE"


def _start() -> list[str]:
    shares = ", ".join(f"{i}.0::DOUBLE / {BINS}" for i in range(1, BINS))
    wide = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEW_FEATURES)
    place = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(FEW_FEATURES)) + " END"
    return [
        f"""cells AS (
  SELECT ride_id, split, {place} AS feature, x
  FROM (SELECT ride_id, split, {wide} FROM few) UNPIVOT (x FOR feature IN ({", ".join(FEW_FEATURES)})))""",
        f"""cuts AS (
  SELECT DISTINCT feature, cut FROM (
    SELECT feature, unnest(quantile_disc(x, [{shares}])) AS cut, max(x) AS most FROM cells WHERE split = 'train' GROUP BY feature)
  WHERE cut < most)""",
        """binned AS MATERIALIZED (
  SELECT ride_id, c.feature, x, coalesce(len(list_filter(l.cuts, lambda e: e < x)), 0) AS bin
  FROM cells c LEFT JOIN (SELECT feature, list(cut) AS cuts FROM cuts GROUP BY feature) l USING (feature))""",
        f"""base AS (
  SELECT sum(floor(price_multiplier * {SCALE} + 0.5::DOUBLE)::BIGINT)::DOUBLE / {SCALE} / count(*) AS base
  FROM few WHERE split = 'train')""",
        "f0 AS MATERIALIZED (SELECT ride_id, split, price_multiplier AS y, base AS f FROM few, base)",
    ]


def _round(t: int, splits: int, leaves: bool, depth: int, min_leaf: int, l2: str) -> list[str]:
    """CTEs of round ``t``: rows with their path, one table per split, then nodes and margins.

    With ``leaves``, a step splits the best leaf; without, every leaf that gains by it.
    """
    parts = [
        f"""s{t}_0 AS MATERIALIZED (
  SELECT ride_id, split, y, f, floor((y - f) * {SCALE} + 0.5::DOUBLE)::BIGINT AS g, '' AS path FROM f{t})"""
    ]
    for k in range(splits):
        parts += [
            f"""h{t}_{k} AS (
  SELECT path, feature, bin, count(*) AS n, sum(g)::BIGINT AS g
  FROM s{t}_{k} JOIN binned USING (ride_id) WHERE split = 'train' AND length(path) < {depth} GROUP BY ALL)""",
            f"""c{t}_{k} AS (
  SELECT path, feature, bin, sum(n) OVER below AS n, sum(g) OVER below::DOUBLE / {SCALE} AS g,
         sum(n) OVER whole AS all_n, (sum(g) OVER whole)::DOUBLE / {SCALE} AS all_g
  FROM h{t}_{k}
  WINDOW below AS (PARTITION BY path, feature ORDER BY bin), whole AS (PARTITION BY path, feature))""".replace(
                "sum(g) OVER below::DOUBLE", "(sum(g) OVER below)::DOUBLE"
            ),
            f"""g{t}_{k} AS (
  SELECT path, feature, bin,
         g * g / (n + {l2}) + (all_g - g) * (all_g - g) / (all_n - n + {l2}) - all_g * all_g / (all_n + {l2}) AS gain
  FROM c{t}_{k} WHERE n >= {min_leaf} AND all_n - n >= {min_leaf})""",
            f"""b{t}_{k} AS MATERIALIZED (
  SELECT path, feature, bin, gain FROM g{t}_{k} WHERE gain > 0
  QUALIFY row_number() OVER ({"" if leaves else "PARTITION BY path "}ORDER BY gain DESC, length(path), path, feature, bin) = 1)""",
            f"""s{t}_{k + 1} AS MATERIALIZED (
  SELECT s.ride_id, split, y, f, g,
         s.path || CASE WHEN b.path IS NULL THEN '' WHEN x.bin <= b.bin THEN 'L' ELSE 'R' END AS path
  FROM s{t}_{k} s LEFT JOIN b{t}_{k} b ON b.path = s.path
       LEFT JOIN binned x ON x.ride_id = s.ride_id AND x.feature = b.feature)""",
        ]
    steps = " UNION ALL ".join(f"SELECT * FROM b{t}_{k}" for k in range(splits))
    parts += [
        f"""k{t} AS (SELECT * FROM ({steps}))""",
        # A node's rows are those whose path begins with its own.
        f"""n{t} AS MATERIALIZED (
  SELECT path, count(*) AS n_rows, sum(g)::BIGINT::DOUBLE / {SCALE} / (count(*) + {l2}) AS value
  FROM (SELECT DISTINCT path FROM (SELECT unnest([path || 'L', path || 'R']) AS path FROM k{t} UNION ALL SELECT ''))
       JOIN (SELECT path AS leaf, g FROM s{t}_{splits} WHERE split = 'train') ON starts_with(leaf, path)
  GROUP BY path)""",
        f"""f{t + 1} AS MATERIALIZED (
  SELECT ride_id, split, y, f + {RATE} * value AS f FROM s{t}_{splits} JOIN n{t} USING (path))""",
    ]
    return parts


def _trees(kind: str) -> list[str]:
    how = {"leafwise": (3, True, 3, 20, "0.0::DOUBLE"), "levelwise": (2, False, 2, 1, "1.0::DOUBLE")}[kind]
    return [*_start(), *(part for t in range(ROUNDS) for part in _round(t, *how))]


def _nodes(t: int) -> str:
    names = "['" + "', '".join(FEW_FEATURES) + "']"
    return f"""
SELECT {t} AS tree, CAST(row_number() OVER (ORDER BY n.path) - 1 AS INTEGER) AS node,
       CAST(length(n.path) AS INTEGER) AS depth, {names}[k.feature + 1] AS feature,
       round(c.cut, 6) + 0.0 AS threshold, round(k.gain, 6) + 0.0 AS gain, n_rows, round(value, 6) + 0.0 AS value
FROM n{t} n LEFT JOIN k{t} k USING (path)
     LEFT JOIN (SELECT feature, cut, row_number() OVER (PARTITION BY feature ORDER BY cut) - 1 AS bin FROM cuts) c
     ON c.feature = k.feature AND c.bin = k.bin"""


def tree_oracles(few: list[str]) -> dict[str, str]:
    """The twins, given the CTEs up to ``few``: ride_id, split, price_multiplier and the features."""
    out = {}
    for kind in ("leafwise", "levelwise"):
        head = "WITH " + ",\n".join([*few, *_trees(kind)]) + "\n"
        out[f"trn_{kind}_trees"] = head + " UNION ALL ".join(_nodes(t) for t in range(ROUNDS))
        out[f"trn_{kind}_predictions"] = head + f"SELECT ride_id, split, round(f, 6) + 0.0 AS prediction FROM f{ROUNDS}"
    return out
