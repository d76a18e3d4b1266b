"""DuckDB twins of the iterative operators: a fixed number of rounds unrolled as CTEs.

Literals are emitted as exact DOUBLE casts of the Python values the Spark side
uses, and expressions keep the Spark side's evaluation order, so both engines
compute the same IEEE values up to summation order.
"""

from __future__ import annotations


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def pagerank_ctes(prefix: str, vertices: str, edges: str, rounds: int, d: float,
                  teleport: str | None = None, dangling: str = "uniform") -> tuple[list[str], str]:
    """CTE texts and the name of the final rank CTE (columns id, pr)."""
    p = prefix
    edge_src = f"(SELECT DISTINCT src, dst FROM {edges})" if dangling == "leak" else edges
    ctes = [
        f"{p}deg AS (SELECT src, count(*) AS outdeg FROM {edges} GROUP BY src)",
        f"{p}we AS (SELECT e.src, e.dst, {dbl(1.0)} / g.outdeg AS w FROM {edge_src} e JOIN {p}deg g ON g.src = e.src)",
        f"{p}nodes AS (SELECT v.id, coalesce(g.outdeg, 0) = 0 AS dang FROM (SELECT DISTINCT id FROM {vertices}) v "
        f"LEFT JOIN {p}deg g ON g.src = v.id)",
        f"{p}nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {p}nodes)",
    ]
    if teleport:
        ctes.append(f"{p}base AS (SELECT nd.id, {dbl(1 - d)} * coalesce(t.v, {dbl(0.0)}) AS b "
                    f"FROM {p}nodes nd LEFT JOIN {teleport} t ON t.id = nd.id)")
    else:
        ctes.append(f"{p}base AS (SELECT nd.id, {dbl(1 - d)} / nn.n AS b FROM {p}nodes nd CROSS JOIN {p}nn nn)")
    ctes.append(f"{p}r0 AS (SELECT nd.id, {dbl(1.0)} / nn.n AS pr FROM {p}nodes nd CROSS JOIN {p}nn nn)")
    for i in range(1, rounds + 1):
        prev = f"{p}r{i - 1}"
        contrib = (f"(SELECT we.dst, sum(r.pr * we.w) AS c FROM {p}we we JOIN {prev} r ON r.id = we.src "
                   f"GROUP BY we.dst)")
        if dangling == "leak":
            ctes.append(
                f"{p}r{i} AS MATERIALIZED (SELECT nd.id, b.b + {dbl(d)} * coalesce(c.c, {dbl(0.0)}) AS pr "
                f"FROM {p}nodes nd JOIN {p}base b ON b.id = nd.id LEFT JOIN {contrib} c ON c.dst = nd.id)")
        else:
            dm = (f"(SELECT sum(r.pr) AS m FROM {prev} r JOIN {p}nodes x ON x.id = r.id WHERE x.dang)")
            ctes.append(
                f"{p}r{i} AS MATERIALIZED (SELECT nd.id, b.b + {dbl(d)} * coalesce(c.c, {dbl(0.0)}) "
                f"+ {dbl(d)} * coalesce(dm.m, {dbl(0.0)}) / nn.n AS pr "
                f"FROM {p}nodes nd JOIN {p}base b ON b.id = nd.id CROSS JOIN {p}nn nn CROSS JOIN {dm} dm "
                f"LEFT JOIN {contrib} c ON c.dst = nd.id)")
    return ctes, f"{p}r{rounds}"


def hits_ctes(prefix: str, vertices: str, edges: str, rounds: int) -> tuple[list[str], str]:
    """CTE texts and final CTE name (columns id, authority, hub)."""
    p = prefix
    ctes = [
        f"{p}e AS (SELECT DISTINCT src, dst FROM {edges})",
        f"{p}v AS (SELECT DISTINCT id FROM {vertices})",
        f"{p}s0 AS (SELECT id, {dbl(1.0)} AS authority, {dbl(1.0)} AS hub FROM {p}v)",
    ]
    one = dbl(1.0)
    for i in range(1, rounds + 1):
        prev = f"{p}s{i - 1}"
        ctes.append(
            f"{p}a{i} AS MATERIALIZED (SELECT v.id, coalesce(x.a, {dbl(0.0)}) AS a FROM {p}v v LEFT JOIN "
            f"(SELECT e.dst, sum(s.hub) AS a FROM {p}e e JOIN {prev} s ON s.id = e.src GROUP BY e.dst) x "
            f"ON x.dst = v.id)")
        ctes.append(
            f"{p}h{i} AS MATERIALIZED (SELECT a.id, a.a, coalesce(x.h, {dbl(0.0)}) AS h FROM {p}a{i} a LEFT JOIN "
            f"(SELECT e.src, sum(a2.a) AS h FROM {p}e e JOIN {p}a{i} a2 ON a2.id = e.dst GROUP BY e.src) x "
            f"ON x.src = a.id)")
        ctes.append(
            f"{p}s{i} AS MATERIALIZED (SELECT h.id, h.a / CASE WHEN nm.na <> 0 THEN nm.na ELSE {one} END AS authority, "
            f"h.h / CASE WHEN nm.nh <> 0 THEN nm.nh ELSE {one} END AS hub FROM {p}h{i} h CROSS JOIN "
            f"(SELECT sqrt(sum(a * a)) AS na, sqrt(sum(h * h)) AS nh FROM {p}h{i}) nm)")
    return ctes, f"{p}s{rounds}"


def with_clause(ctes: list[str]) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
