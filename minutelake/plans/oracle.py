"""DuckDB SQL for the scenario tables, mirroring ``fixtures.Scenario``.

Each CTE is declared once with its dependencies; ``sql(body, *names)`` prepends
the CTEs a query needs in dependency order.
"""

from __future__ import annotations

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    _CTES[name] = (deps, body)


def sql(body: str, *names: str, local_ctes: bool = False) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    defs = [f"{n} AS ({_CTES[n][1].strip()})" for n in order]
    body = body.strip()
    if local_ctes:
        # the body starts with its own CTE definitions: ``x AS (...), ... SELECT ...``
        return "WITH " + ",\n".join(defs + [body])
    if not defs:
        return body
    return "WITH " + ",\n".join(defs) + "\n" + body


def minute_dir(x: str) -> str:
    return f"strftime({x}, '%Y/%m/%d/%H/%M')"


NOW = "TIMESTAMP '2024-01-31 00:00:00'"

cte("cat", """
SELECT CASE WHEN user_id % 3 = 2 THEN 'cluster2' ELSE 'cluster1' END AS cluster,
       event_type AS stream, concat('collector', user_id % 3) AS collector,
       date_trunc('minute', ts) AS minute,
       concat(event_type, '-', strftime(date_trunc('minute', ts), '%Y-%m-%d-%H-%M'), '_00000') AS file_name,
       max(ts) AS mtime, count(*) AS n_records, CAST(sum(length(props)) AS BIGINT) AS length,
       CAST(strftime(date_trunc('minute', ts), '%H%M') AS INT) AS hhmm
FROM events GROUP BY 1, 2, 3, 4, 5, 9""")

cte("cf", """
SELECT cluster, stream, collector, file_name,
       concat('/', cluster, '/data/', stream, '/', collector, '/', file_name) AS path, mtime, length, minute, hhmm
FROM cat""", "cat")

cte("lf", f"""
SELECT cluster, 'streams_local' AS base, stream, minute + INTERVAL 1 MINUTE AS minute,
       concat(collector, '-', file_name, '.gz') AS file_name,
       concat('/', cluster, '/streams_local/', stream, '/', {minute_dir("minute + INTERVAL 1 MINUTE")}, '/',
              collector, '-', file_name, '.gz') AS path,
       mtime + INTERVAL 1 MINUTE AS mtime, length, hhmm, collector
FROM cat""", "cat")

cte("mf", f"""
SELECT 'cluster1' AS cluster, 'streams' AS base, stream, minute + INTERVAL 2 MINUTE AS minute,
       concat(collector, '-', file_name, '.gz') AS file_name,
       concat('/cluster1/streams/', stream, '/', {minute_dir("minute + INTERVAL 2 MINUTE")}, '/',
              collector, '-', file_name, '.gz') AS path,
       mtime + INTERVAL 2 MINUTE AS mtime, length, hhmm, collector
FROM cat""", "cat")

cte("sources", """
SELECT * FROM (VALUES ('click','cluster1',48),('click','cluster2',72),('view','cluster1',96),('view','cluster2',96),
                      ('error','cluster2',24)) AS s(stream, cluster, retention_hours)""")
cte("destinations", """
SELECT * FROM (VALUES ('click','cluster1',true,24),('click','cluster3',false,120),('view','cluster2',true,48),
                      ('view','cluster1',false,48)) AS d(stream, cluster, is_primary, retention_hours)""")


def classify_sql(src: str, dst: str, group: list[str]) -> str:
    """Rule C9 over two CTEs with columns ``group..., key, path``."""
    g = ", ".join(group)
    on = " AND ".join(f"s.{c} = d.{c}" for c in group + ["key"])
    gsel = ", ".join(f"coalesce(s.{c}, d.{c}) AS {c}" for c in group)
    jon_s = " AND ".join(f"j.{c} = smax.{c}" for c in group)
    jon_d = " AND ".join(f"j.{c} = dmax.{c}" for c in group)
    jg = ", ".join(f"j.{c}" for c in group)
    return f"""
s_ AS (SELECT {g}, key, max(path) AS path FROM {src} GROUP BY {g}, key),
d_ AS (SELECT {g}, key, max(path) AS path FROM {dst} GROUP BY {g}, key),
smax AS (SELECT {g}, max(key) AS m FROM s_ GROUP BY {g}),
dmax AS (SELECT {g}, max(key) AS m FROM d_ GROUP BY {g}),
j AS (SELECT {gsel}, coalesce(s.key, d.key) AS key, s.path AS sp, d.path AS dp,
             s.key IS NOT NULL AS ins, d.key IS NOT NULL AS ind
      FROM s_ s FULL OUTER JOIN d_ d ON {on})
SELECT {jg}, j.key,
       CASE WHEN NOT ind THEN (CASE WHEN dmax.m IS NULL OR j.key > dmax.m THEN 'to_be_sent' ELSE 'missing' END)
            ELSE (CASE WHEN smax.m IS NULL OR j.key > smax.m THEN 'extra' ELSE 'replay' END) END AS kind,
       coalesce(sp, dp) AS path
FROM j LEFT JOIN smax ON {jon_s} LEFT JOIN dmax ON {jon_d}
WHERE NOT (ins AND ind)"""

# ---- ingest scenario -------------------------------------------------------------------------
cte("dirty", """
SELECT cluster, stream, collector, fname AS file_name,
       concat('/', cluster, '/data/', stream, '/', collector, '/', fname) AS path, mtime,
       CASE WHEN minute(minute) % 10 = 3 THEN CAST(0 AS BIGINT) ELSE length END AS length
FROM (SELECT *, CASE WHEN minute(minute) % 10 = 1 THEN concat(stream, '_current')
                     WHEN minute(minute) % 10 = 2 AND hour(minute) % 2 = 1 THEN 'SCRIBE_STATS'
                     WHEN minute(minute) % 10 = 2 THEN 'scribe_stats' ELSE file_name END AS fname FROM cat)""", "cat")
cte("named", "SELECT * FROM dirty WHERE NOT ends_with(file_name, 'current') AND lower(file_name) <> 'scribe_stats'",
    "dirty")


def closed_cte(name: str, timeout: str) -> None:
    cte(f"cur_{name}", f"""
SELECT cluster, stream, collector, lower(file_name) AS cur FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster, stream, collector ORDER BY mtime DESC, file_name DESC) AS rn
  FROM named) WHERE rn = 1 AND mtime > {NOW} - INTERVAL {timeout}""", "named")
    cte(f"closed_{name}", f"""
SELECT n.cluster, n.stream, n.collector, n.file_name, n.path, n.mtime, n.length
FROM named n LEFT JOIN cur_{name} c ON n.cluster = c.cluster AND n.stream = c.stream AND n.collector = c.collector
WHERE (c.cur IS NULL OR lower(n.file_name) <> c.cur) AND n.length > 0""", f"cur_{name}")


closed_cte("4h", "4 HOUR")
closed_cte("5m", "5 MINUTE")
cte("ckpt", """
SELECT cluster, stream, collector, max(file_name) AS file_name FROM cat
WHERE minute < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2, 3""", "cat")
cte("above", """
SELECT c.* FROM closed_5m c LEFT JOIN ckpt k ON c.cluster = k.cluster AND c.stream = k.stream AND c.collector = k.collector
WHERE k.file_name IS NULL OR c.file_name > k.file_name""", "closed_5m", "ckpt")
cte("rec", """
SELECT CASE WHEN user_id % 3 = 2 THEN 'cluster2' ELSE 'cluster1' END AS cluster, event_type AS stream,
       concat('collector', user_id % 3) AS collector,
       concat(event_type, '-', strftime(date_trunc('minute', ts), '%Y-%m-%d-%H-%M'), '_00000') AS src_file,
       date_trunc('minute', ts) AS minute, props AS value, event_id AS record_no
FROM events""")
cte("new_rec", """
SELECT r.* FROM rec r WHERE EXISTS (SELECT 1 FROM above a WHERE a.cluster = r.cluster AND a.stream = r.stream
  AND a.collector = r.collector AND a.file_name = r.src_file)""", "rec", "above")
cte("pub_local", """
SELECT cluster, 'streams_local' AS base, stream, minute + INTERVAL 1 MINUTE AS minute,
       concat(collector, '-', src_file, '.gz') AS file_name, collector, src_file, value, record_no FROM new_rec""", "new_rec")
cte("prim", "SELECT DISTINCT stream, cluster AS primary_cluster FROM destinations WHERE coalesce(is_primary, false)",
    "destinations")
cte("medges", """
SELECT s.stream, s.cluster AS src_cluster, p.primary_cluster AS dest_cluster FROM sources s JOIN prim p ON s.stream = p.stream""",
    "sources", "prim")
cte("redges", """
SELECT d.stream, p.primary_cluster AS src_cluster, d.cluster AS dest_cluster FROM destinations d
JOIN prim p ON d.stream = p.stream WHERE NOT coalesce(d.is_primary, false)""", "destinations", "prim")
cte("pub_merge", """
SELECT e.dest_cluster AS cluster, 'streams' AS base, l.stream, l.minute + INTERVAL 1 MINUTE AS minute, l.file_name,
       l.collector, l.src_file, l.value, l.record_no
FROM pub_local l JOIN medges e ON l.stream = e.stream AND l.cluster = e.src_cluster""", "pub_local", "medges")

# ---- minute directories ----------------------------------------------------------------------
cte("ldm", "SELECT cluster, base, stream, minute, max(mtime) AS created_at, count(*) AS n_files FROM lf GROUP BY 1, 2, 3, 4",
    "lf")
cte("mdm", "SELECT cluster, base, stream, minute FROM mf GROUP BY 1, 2, 3, 4", "mf")
cte("mgap", """
SELECT cluster, base, stream,
       unnest(generate_series(minute + INTERVAL 1 MINUTE, nm - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS minute
FROM (SELECT *, lead(minute) OVER (PARTITION BY cluster, base, stream ORDER BY minute) AS nm FROM mdm)
WHERE nm > minute + INTERVAL 1 MINUTE""", "mdm")
cte("ment", f"""
SELECT cluster, base, stream, minute, concat({minute_dir("minute")}, '/', file_name) AS relpath, 'file' AS entry, path
FROM mf
UNION ALL
SELECT cluster, base, stream, minute, {minute_dir("minute")} AS relpath, 'dir' AS entry,
       concat('/', cluster, '/', base, '/', stream, '/', {minute_dir("minute")}) AS path
FROM mgap""", "mf", "mgap")
cte("mir", f"""
SELECT 'cluster3' AS mirror, stream, relpath AS key, path FROM ment
WHERE NOT ((entry = 'file' AND CAST(strftime(minute, '%H%M') AS INT) % 19 = 0)
        OR (entry = 'dir' AND CAST(strftime(minute, '%H%M') AS INT) % 97 = 0))
UNION ALL
SELECT 'cluster3' AS mirror, stream,
       concat({minute_dir("minute + INTERVAL 1 MINUTE")}, '/', regexp_extract(relpath, '[^/]+$')) AS key, path
FROM ment WHERE entry = 'file' AND CAST(strftime(minute, '%H%M') AS INT) % 31 = 0""", "ment")

# ---- local audit and trash -------------------------------------------------------------------
cte("ranked", """
SELECT *, row_number() OVER (PARTITION BY cluster, stream, collector ORDER BY file_name DESC) AS rn FROM cf""", "cf")
cte("trash", """
SELECT cluster, date_trunc('hour', mtime + INTERVAL 1 MINUTE) AS trash_hour, stream, collector,
       concat(collector, '-', file_name) AS file_name,
       concat('/', cluster, '/system/trash/', strftime(mtime + INTERVAL 1 MINUTE, '%Y-%-m-%-d/%-H'), '/',
              collector, '-', file_name) AS path
FROM ranked WHERE rn > 6""", "ranked")
cte("tdirs", """
SELECT DISTINCT cluster, strftime(trash_hour, '%Y-%-m-%-d') AS day_dir,
       CASE WHEN hour(trash_hour) = 13 THEN concat(strftime(trash_hour, '%-H'), 'x') ELSE strftime(trash_hour, '%-H') END
         AS hour_dir
FROM trash""", "trash")

# ---- retention -------------------------------------------------------------------------------
cte("eff", """
SELECT cluster, stream, max(coalesce(retention_hours, 48)) AS retention_hours
FROM (SELECT cluster, stream, retention_hours FROM sources UNION ALL SELECT cluster, stream, retention_hours FROM destinations)
GROUP BY 1, 2""", "sources", "destinations")
cte("allf", """
SELECT cluster, base, stream, minute, file_name, path, mtime, length FROM lf
UNION ALL SELECT cluster, base, stream, minute, file_name, path, mtime, length FROM mf""", "lf", "mf")
cte("pur", f"""
SELECT h.cluster, h.base, h.stream, h.hour, abs(epoch_us({NOW}) - epoch_us(h.hour)) // 3600000000 AS age_hours,
       coalesce(e.retention_hours, 48) AS retention_hours
FROM (SELECT DISTINCT cluster, base, stream, date_trunc('hour', minute) AS hour FROM allf) h
LEFT JOIN eff e ON h.cluster = e.cluster AND h.stream = e.stream
WHERE abs(epoch_us({NOW}) - epoch_us(h.hour)) // 3600000000 >= coalesce(e.retention_hours, 48)""", "allf", "eff")

# ---- manifests -------------------------------------------------------------------------------
cte("man0", """
SELECT 'merge' AS kind, l.cluster AS src_cluster, l.cluster AS via_cluster, e.dest_cluster, l.stream, l.path, l.minute,
       CAST(l.hhmm % 3 AS BIGINT) AS batch_id, l.hhmm
FROM lf l JOIN medges e ON l.stream = e.stream AND l.cluster = e.src_cluster""", "lf", "medges")
cte("man", """
SELECT kind, src_cluster, via_cluster, dest_cluster, stream,
       CASE WHEN hhmm % 7 = 0 THEN concat(path, ' ') ELSE path END AS path, minute, batch_id
FROM (SELECT * FROM man0 UNION ALL
      SELECT kind, src_cluster, via_cluster, dest_cluster, stream, path, minute, CAST(2 AS BIGINT), hhmm
      FROM man0 WHERE hhmm % 5 = 0)""", "man0")
cte("acks", "SELECT DISTINCT kind, dest_cluster, CAST(0 AS BIGINT) AS batch_id FROM man", "man")
cte("acked", """
SELECT DISTINCT kind, dest_cluster, batch_id FROM man m
WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.kind = m.kind AND a.dest_cluster = m.dest_cluster AND a.batch_id = m.batch_id)
  AND dest_cluster = 'cluster1'""", "man", "acks")
cte("pend", """
SELECT kind, dest_cluster, stream, trim(path) AS path, max(batch_id) AS batch_id, min(minute) AS minute
FROM man m WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.kind = m.kind AND a.dest_cluster = m.dest_cluster
                                                    AND a.batch_id = m.batch_id)
GROUP BY 1, 2, 3, 4""", "man", "acks")

cte("audit_merge_rows", "WITH src AS (SELECT stream, file_name AS key, path FROM lf WHERE hhmm % 17 <> 0),\n"
    "dst AS (SELECT stream, file_name AS key, path FROM mf WHERE hhmm % 19 <> 0),"
    + classify_sql("src", "dst", ["stream"]), "lf", "mf")
cte("lvl", """
SELECT DISTINCT cluster, base, stream, level, concat('/', cluster, '/', base, '/', stream, '/', p) AS path FROM (
  SELECT cluster, base, stream, 'year' AS level, strftime(minute, '%Y') AS p FROM lf
  UNION ALL SELECT cluster, base, stream, 'month', strftime(minute, '%Y/%m') FROM lf
  UNION ALL SELECT cluster, base, stream, 'day', strftime(minute, '%Y/%m/%d') FROM lf
  UNION ALL SELECT cluster, base, stream, 'hour', strftime(minute, '%Y/%m/%d/%H') FROM lf
  UNION ALL SELECT cluster, base, stream, 'month', '2024/02' FROM lf
  UNION ALL SELECT cluster, base, stream, 'day', '2024/01/31' FROM lf)""", "lf")
