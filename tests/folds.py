"""Expected results of the order-dependent operators, from their stated rules.

Nothing here steps through a list with state: each function states what must
hold of the whole sequence, as set arithmetic over prefixes or as recursive SQL
that DuckDB runs. They are quadratic and for small inputs only.
"""

from __future__ import annotations

import duckdb


def versions_expected(events, registry):
    """events: (key, cat, origin, conf) in arrival order; registry:
    {(key, cat): [(origin, version, score or None)]}. -> [(version, action)].

    An origin's version is the stored one, else the highest stored one plus its
    rank among the new origins of its (key, cat) by first arrival. An event is a
    new version at its origin's first arrival; else it overwrites if no earlier
    score of that origin, stored or arrived, is higher."""
    out = []
    for i, (key, cat, origin, conf) in enumerate(events):
        stored = registry.get((key, cat), [])
        versions = {o: v for o, v, _ in stored}
        before = [e for e in events[:i] if e[:2] == (key, cat)]
        own = [c for _, _, o, c in before if o == origin]
        arrivals = [o for _, _, o, _ in before if o not in versions]
        new = sorted(set(arrivals), key=arrivals.index)
        if origin in versions:
            version = versions[origin]
            scores = own + [s or 0 for o, _, s in stored if o == origin]
        else:
            version = max(versions.values(), default=0) + (new.index(origin) if own else len(new)) + 1
            scores = own
        if not scores:
            out.append((version, "VERSIONAR" if versions or before else "NUEVO"))
        else:
            out.append((version, "SOBRESCRIBIR" if conf >= max(scores) else "DESCARTAR"))
    return out


def _sql(text, values):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i BIGINT, x BIGINT)")
    if values:
        con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(text).fetchall()]


def lots_of_pages(pages, most):
    """Lot number of each file: lots begin at the first file and, from each begin,
    at the first later file whose sum from there goes over ``most``."""
    return _sql(f"""
        WITH RECURSIVE s AS (SELECT i, sum(x) OVER (ORDER BY i) AS upto, x FROM t),
        b AS (SELECT 0::BIGINT AS i WHERE EXISTS (SELECT 1 FROM t) UNION ALL
              SELECT (SELECT min(n.i) FROM s n, s f WHERE f.i = b.i AND n.i > b.i AND n.upto - f.upto + f.x > {most})
              FROM b WHERE b.i IS NOT NULL)
        SELECT (SELECT count(*) FROM b WHERE b.i <= t.i) - 1 FROM t ORDER BY i""", pages)


def lots_of_bursts(times, least, gap):
    """Lot number of each image: a lot ends at the first image that is at least the
    ``least``-th of its lot and whose successor comes ``gap`` or more later."""
    return _sql(f"""
        WITH RECURSIVE g AS (SELECT i, coalesce(lead(x) OVER (ORDER BY i) - x >= {gap}, false) AS pause FROM t),
        b AS (SELECT 0::BIGINT AS i WHERE EXISTS (SELECT 1 FROM t) UNION ALL
              SELECT (SELECT min(g.i) + 1 FROM g WHERE g.pause AND g.i >= b.i + {least} - 1) FROM b WHERE b.i IS NOT NULL)
        SELECT (SELECT count(*) FROM b WHERE b.i <= t.i) - 1 FROM t ORDER BY i""", times)


def examples_expected(folios, init=(), keep=3):
    """The held examples: by recursive SQL over the arrivals, a folio that is not
    held is appended and the last ``keep`` are held."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i BIGINT, f VARCHAR)")
    if folios:
        con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(folios)))
    return con.execute(f"""
        WITH RECURSIVE r AS (SELECT 0::BIGINT AS i, ?::VARCHAR[] AS held UNION ALL
            SELECT r.i + 1, CASE WHEN list_contains(held, f) THEN held ELSE list_append(held, f)[-{keep}:] END
            FROM r JOIN t ON t.i = r.i)
        SELECT held FROM r ORDER BY i DESC LIMIT 1""", [list(init)]).fetchall()[0][0]
