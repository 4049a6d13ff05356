"""Recording tables made from the given tables: sessions, scans, events, files, participants and samples.

Each view has its definition for DuckDB beside it, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subject, name, s, e: start and end in epoch seconds; some are reversed."""
    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("subject"), F.expr("concat('rec-', event_id)").alias("name"), F.expr("event_id % 97 = 0").alias("turn"),
        F.expr("cast(floor(unix_micros(cast(ts as timestamp)) / 1000000) as bigint)").alias("a"), F.expr("cast(floor(least(value, 20) * 3600) as bigint)").alias("d"),
    )
    return e.selectExpr("subject", "name", "if(turn, a + d, a) as s", "if(turn, a, a + d) as e")


SESSIONS = """sessions AS (SELECT user_id AS subject, 'rec-' || event_id AS name, CASE WHEN event_id % 97 = 0 THEN a + d ELSE a END AS s, CASE WHEN event_id % 97 = 0 THEN a ELSE a + d END AS e
FROM (SELECT *, epoch_us(ts) // 1000000 AS a, cast(floor(least(value, 20) * 3600) AS bigint) AS d FROM events))"""


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sub, ses, filename, acq_time, duration (hours as text), edf_type, day, hours."""
    o = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey % 50 as sub", "o_orderkey as k", "o_orderdate as d", "floor(o_totalprice) % 24 + if(o_orderkey % 3 = 0, 0.5, 0.0) as hours",
        "case o_orderstatus when 'F' then 'EDF+C' when 'O' then 'EDF+D' else 'EDF' end as edf_type",
        "date_add(date'2024-01-01', cast(datediff(o_orderdate, date'1995-01-01') % 60 as int)) as day",
    )
    o = o.selectExpr("*", "cast(row_number() over (partition by sub order by d, k) as bigint) as ses", "concat(lpad(cast(k % 24 as string), 2, '0'), ':', lpad(cast(k % 60 as string), 2, '0'), ':', lpad(cast(k % 59 as string), 2, '0')) as clock")
    return o.selectExpr(
        "sub", "ses", "concat('ses-', lpad(cast(ses as string), 3, '0'), '/ieeg/sub-', lpad(cast(sub as string), 3, '0'), '_ses-', lpad(cast(ses as string), 3, '0'), if(k % 5 = 0, '_task-clip', '_task-full'), if(k % 7 = 0, '', '_run-01'), '_ieeg.edf') as filename",
        "concat(cast(day as string), 'T', clock) as acq_time", "cast(cast(hours as double) as string) as duration", "edf_type", "cast(day as string) as day", "cast(hours as double) as hours",
    )


SCANS = """scans AS (SELECT sub, ses, 'ses-' || lpad(ses::varchar, 3, '0') || '/ieeg/sub-' || lpad(sub::varchar, 3, '0') || '_ses-' || lpad(ses::varchar, 3, '0') || CASE WHEN k % 5 = 0 THEN '_task-clip' ELSE '_task-full' END || CASE WHEN k % 7 = 0 THEN '' ELSE '_run-01' END || '_ieeg.edf' AS filename,
day || 'T' || lpad((k % 24)::varchar, 2, '0') || ':' || lpad((k % 60)::varchar, 2, '0') || ':' || lpad((k % 59)::varchar, 2, '0') AS acq_time, hours::varchar AS duration, edf_type, day, hours
FROM (SELECT o_custkey % 50 AS sub, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderdate, o_orderkey) AS ses, (floor(o_totalprice) % 24 + CASE WHEN o_orderkey % 3 = 0 THEN 0.5 ELSE 0 END)::double AS hours,
CASE o_orderstatus WHEN 'F' THEN 'EDF+C' WHEN 'O' THEN 'EDF+D' ELSE 'EDF' END AS edf_type, (DATE '2024-01-01' + (datediff('day', DATE '1995-01-01', o_orderdate::date) % 60)::int)::varchar AS day FROM orders))"""


def events_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec, seq, onset (seconds since the recording's first event, to the microsecond), text."""
    e = table(spark, sf_dir, "events").selectExpr("user_id as rec", "event_id as k", "unix_micros(cast(ts as timestamp)) as us", "event_type as kind", "value", "props")
    e = e.selectExpr("*", "cast(row_number() over (partition by rec order by us, k) as bigint) as seq", "us - min(us) over (partition by rec) as rel")
    text = """case when k % 11 = 0 then concat('Stim Start A', k % 7 + 1, '-A', k % 7 + 2, ' ', k % 5 + 1, '.0')
        when k % 11 = 1 then concat('Start Stimulation from B', k % 4 + 1, ' to B', k % 4 + 2, if(k % 3 = 0, '', concat(' current=', k % 6 + 1)))
        when k % 11 = 2 then concat('Closed relay to LA', k % 5 + 1, ' and LA', k % 5 + 2) when k % 11 = 3 then cast(k % 9 + 1 as string)
        when k % 11 = 4 then 'Opened relay' when k % 11 = 5 then 'high freq' when k % 13 = 6 then '' when k % 13 = 7 then 'é' else concat(kind, ' note ', cast(k % 50 as string)) end"""
    return e.selectExpr("rec", "seq", "rel / 1000000.0D as onset", f"{text} as text")


EVENTS_TSV = """events_tsv AS (SELECT rec, seq, rel / 1000000.0::double AS onset, CASE WHEN k % 11 = 0 THEN 'Stim Start A' || (k % 7 + 1) || '-A' || (k % 7 + 2) || ' ' || (k % 5 + 1) || '.0'
WHEN k % 11 = 1 THEN 'Start Stimulation from B' || (k % 4 + 1) || ' to B' || (k % 4 + 2) || CASE WHEN k % 3 = 0 THEN '' ELSE ' current=' || (k % 6 + 1) END
WHEN k % 11 = 2 THEN 'Closed relay to LA' || (k % 5 + 1) || ' and LA' || (k % 5 + 2) WHEN k % 11 = 3 THEN (k % 9 + 1)::varchar WHEN k % 11 = 4 THEN 'Opened relay' WHEN k % 11 = 5 THEN 'high freq'
WHEN k % 13 = 6 THEN '' WHEN k % 13 = 7 THEN 'é' ELSE kind || ' note ' || (k % 50) END AS text
FROM (SELECT user_id AS rec, event_id AS k, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) AS rel FROM events))"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sub, ses, run, path, name, ext, length, md5, mtime (epoch seconds), text."""
    d = table(spark, sf_dir, "documents").selectExpr("doc_id as k", "text", "doc_id % 20 as sub", "cast(floor(doc_id / 20) % 8 as bigint) as ses", "cast(floor(doc_id / 160) % 3 as bigint) as run")
    ext = "element_at(array('.edf', '.tsv', '.json', '.edf.gz', '.txt', '.md5', '.pdf'), cast(k % 7 as int) + 1)"
    name = f"concat('sub-', lpad(cast(sub as string), 3, '0'), '_ses-', lpad(cast(if(k % 41 = 0, ses + 1, ses) as string), 3, '0'), '_task-full_run-', lpad(cast(run as string), 2, '0'), '_', if(k % 7 = 1, 'events', 'ieeg'), {ext})"
    return d.selectExpr(
        "sub", "ses", "run", f"concat('sub-', lpad(cast(sub as string), 3, '0'), '/ses-', lpad(cast(ses as string), 3, '0'), '/ieeg/', {name}) as path", f"{name} as name", f"{ext} as ext",
        "cast(if(k % 53 = 0, 0, length(text)) as bigint) as length", "if(k % 31 = 0, null, md5(cast(text as binary))) as md5", "1704067200 + (k * 7919) % 2592000 as mtime", "k as file_id", "text",
    )


FILES = """files AS (SELECT sub, ses, run, 'sub-' || lpad(sub::varchar, 3, '0') || '/ses-' || lpad(ses::varchar, 3, '0') || '/ieeg/' || name AS path, name, ext, CASE WHEN k % 53 = 0 THEN 0 ELSE length(text) END::bigint AS length, CASE WHEN k % 31 = 0 THEN NULL ELSE md5(text) END AS md5, 1704067200 + (k * 7919) % 2592000 AS mtime, k AS file_id, text
FROM (SELECT *, 'sub-' || lpad(sub::varchar, 3, '0') || '_ses-' || lpad((CASE WHEN k % 41 = 0 THEN ses + 1 ELSE ses END)::varchar, 3, '0') || '_task-full_run-' || lpad(run::varchar, 2, '0') || '_' || CASE WHEN k % 7 = 1 THEN 'events' ELSE 'ieeg' END || ext AS name
FROM (SELECT doc_id AS k, text, doc_id % 20 AS sub, (doc_id // 20) % 8 AS ses, (doc_id // 160) % 3 AS run, (['.edf', '.tsv', '.json', '.edf.gz', '.txt', '.md5', '.pdf'])[(doc_id % 7 + 1)::int] AS ext FROM documents)))"""


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, id, age, sex, grp: raw text columns as a spreadsheet has them; some ids come twice."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as idx", "concat('sub-', lpad(cast(c_custkey % 1000 as string), 4, '0')) as id", "case when c_custkey % 17 = 0 then 'n/a' else cast(c_custkey % 100 as string) end as age",
        "element_at(array('m', 'Male', '1', 'f', 'Woman', '0', ' M ', 'x'), cast(c_custkey % 8 as int) + 1) as sex", "case when c_custkey % 5 = 0 then '' else lower(c_mktsegment) end as grp",
    )


DEMOGRAPHICS = """demographics AS (SELECT c_custkey AS idx, 'sub-' || lpad((c_custkey % 1000)::varchar, 4, '0') AS id, CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE (c_custkey % 100)::varchar END AS age,
(['m', 'Male', '1', 'f', 'Woman', '0', ' M ', 'x'])[(c_custkey % 8 + 1)::int] AS sex, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE lower(c_mktsegment) END AS grp FROM customer)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec, channel, idx, v: a signal for each supplier and line number, in the order of its orders."""
    li = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey % 40 as rec", "cast(l_linenumber as bigint) as channel", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice as v", "l_quantity as q")
    return li.selectExpr("rec", "channel", "cast(row_number() over (partition by rec, channel order by l_orderkey, l_partkey, l_suppkey, v, q) as bigint) - 1 as idx", "v")


SAMPLES = """samples AS MATERIALIZED (SELECT l_suppkey % 40 AS rec, l_linenumber::bigint AS channel, row_number() OVER (PARTITION BY l_suppkey % 40, l_linenumber ORDER BY l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS idx, l_extendedprice AS v FROM lineitem)"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, text: documents, some with personal data put in front."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id as doc", """concat(case when doc_id % 9 = 0 then concat('Seen 2024-01-', lpad(cast(doc_id % 28 + 1 as string), 2, '0'), ' by Dr Smith. ') when doc_id % 9 = 1 then concat('DOB: ', doc_id % 12 + 1, '/', doc_id % 28 + 1, '/1980 mail jane.doe', doc_id, '@mail.org. ')
        when doc_id % 9 = 2 then concat('Call 555-123-', lpad(cast(doc_id % 10000 as string), 4, '0'), ' MRN 00', 1000000 + doc_id, '. ') else '' end, text) as text""",
    )


TEXTS = """texts AS (SELECT doc_id AS doc, CASE WHEN doc_id % 9 = 0 THEN 'Seen 2024-01-' || lpad((doc_id % 28 + 1)::varchar, 2, '0') || ' by Dr Smith. ' WHEN doc_id % 9 = 1 THEN 'DOB: ' || (doc_id % 12 + 1) || '/' || (doc_id % 28 + 1) || '/1980 mail jane.doe' || doc_id || '@mail.org. '
WHEN doc_id % 9 = 2 THEN 'Call 555-123-' || lpad((doc_id % 10000)::varchar, 4, '0') || ' MRN 00' || (1000000 + doc_id) || '. ' ELSE '' END || text AS text FROM documents)"""


def oracle(views: list[str], body: str) -> str:
    """A query for DuckDB over these views."""
    return "WITH " + ",\n".join([*views, body]) if body.lstrip()[:6].upper() != "SELECT" else "WITH " + ",\n".join(views) + "\n" + body
