"""SQL fragments shared by the expected results."""

from __future__ import annotations

import math

BLANK = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"
NOT_BLANK = r"[^\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"


def clean(c: str) -> str:
    deleted = r"""[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{|}~—«»]|\p{Nd}+"""
    return f"trim(regexp_replace(regexp_replace(lower({c}), '{deleted}', '', 'g'), '{BLANK}+', ' ', 'g'))"


def tokens(c: str) -> str:
    """Tokens of a text that may hold any blanks."""
    return f"list_filter(regexp_split_to_array({c}, '{BLANK}+'), lambda t: t <> '')"


def rnd(c: str, digits: int) -> str:
    """Rounded, without negative zero."""
    return f"round(CAST({c} AS DOUBLE), {digits}) + 0.0"


def lon(key: str) -> str:
    return f"(37.3::DOUBLE + (({key} * 7919) % 6007)::DOUBLE / 10000::DOUBLE)"


def lat(key: str) -> str:
    return f"(55.5::DOUBLE + (({key} * 104729) % 4507)::DOUBLE / 10000::DOUBLE)"


def haversine(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"(12734000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
        f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))"
    )


def boxcox_ctes(data: str, value: str, group: str = "'all'") -> str:
    """CTEs ending in `lam(g, lmbda)`: narrowing grids of their own, finer than the operator's, by plain cross products."""
    first = ", ".join(f"({i}, {math.sinh(0.5 * i)!r}::DOUBLE)" for i in range(-12, 13))
    out = [
        f"logs AS (SELECT {group} AS g, ln({value}) - avg(ln({value})) OVER (PARTITION BY {group}) AS lg FROM {data} "
        f"WHERE {value} > 0)",
        f"grid0 AS (SELECT gs.g, v.i, v.lam FROM (SELECT DISTINCT g FROM logs) gs, (VALUES {first}) v(i, lam))",
    ]
    for look in range(5):
        out.append(
            f"llf{look} AS (SELECT g, i, lam, lag(lam) OVER w AS low, lead(lam) OVER w AS high, llf, "
            f"lag(llf) OVER w AS before, lead(llf) OVER w AS after FROM (SELECT g, i, lam, CASE WHEN isfinite(llf) THEN llf END AS llf FROM (SELECT q.g, q.i, q.lam, "
            f"(q.lam - 1) * avg(lg) - 0.5 * ln(var_pop(CASE WHEN abs(q.lam) < 1e-12 THEN lg "
            f"ELSE (exp(q.lam * lg) - 1) / q.lam END)) AS llf FROM logs JOIN grid{look} q USING (g) "
            f"GROUP BY q.g, q.i, q.lam)) WINDOW w AS (PARTITION BY g ORDER BY i))"
        )
        out.append(
            f"best{look} AS (SELECT * FROM llf{look} QUALIFY row_number() OVER (PARTITION BY g ORDER BY llf DESC NULLS LAST, i) = 1)"
        )
        if look < 4:
            out.append(
                f"grid{look + 1} AS (SELECT g, n AS i, low + n * ((high - low) / 16) AS lam "
                f"FROM best{look}, generate_series(0, 16) s(n))"
            )
    out.append(
        "lam AS (SELECT g, lam + (high - lam) * 0.5 * (before - after) / (before - 2 * llf + after) AS lmbda FROM best4)"
    )
    return ", ".join(out)
