"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark import views as v
from tidemark.operators import intervals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, run: Callable[[SparkSession, str], DataFrame], views: list[str] | None = None, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql:
        ORACLES[name] = v.oracle(views or [], sql) if views else sql if sql.lstrip()[:6].upper() in ("SELECT",) else f"WITH {sql}"


register("W1_coverage_union_by_day", lambda s, d: intervals.coverage_union_by_day(v.sessions(s, d)), [v.SESSIONS], intervals.W1_SQL)
register("A3_coverage_simple", lambda s, d: intervals.coverage_simple(v.sessions(s, d)), [v.SESSIONS], intervals.A3_SQL)
register("J4_coverage_overlaps", lambda s, d: intervals.coverage_overlaps(v.sessions(s, d)), [v.SESSIONS], intervals.J4_SQL)
register("D4_interval_union", lambda s, d: intervals.interval_union(v.sessions(s, d)), [v.SESSIONS], intervals.D4_SQL)

from tidemark.operators import manifest as m  # noqa: E402
from tidemark.plans import renumber as u  # noqa: E402

PAD = lambda c: f"lpad(({c})::varchar, 3, '0')"
register(
    "S3_parse_bids_name", lambda s, d: m.parse_bids_name(v.scans(s, d)), [v.SCANS],
    r"""SELECT filename, nullif(regexp_extract(filename, '(sub-\d+)_ses', 1), '') AS subject, nullif(regexp_extract(filename, '_(ses-\d+)', 1), '') AS session, nullif(regexp_extract(filename, '_task-([A-Za-z0-9]+)', 1), '') AS task,
    nullif(regexp_extract(filename, '_run-(\d+)', 1), '') AS run, 'ieeg' AS suffix, '.edf' AS ext, true AS valid FROM scans""",
)
register(
    "P2_validate_scans_columns", lambda s, d: m.validate_scans_columns(v.scans(s, d).selectExpr("filename as ` Filename`", "acq_time as Acq_Time", "duration", "if(ses % 4 = 0, '', edf_type) as Format")), [v.SCANS],
    "SELECT filename, acq_time, duration, CASE WHEN ses % 4 = 0 THEN 'n/a' ELSE edf_type END AS format FROM scans WHERE filename LIKE '%ieeg/%'",
)
register(
    "P5_recording_type", lambda s, d: m.recording_type(v.scans(s, d).selectExpr("filename", "sub * 2 as n_signals", "hours", "edf_type"), "n_signals", "hours", "edf_type"), [v.SCANS],
    "SELECT filename, sub * 2 AS n_signals, hours, edf_type, CASE WHEN sub * 2 >= 60 THEN 'iEEG' ELSE 'Scalp' END AS kind, CASE WHEN hours < 5 THEN 'clip' ELSE 'full' END AS task, edf_type AS container FROM scans",
)
register(
    "P6_bids_class", lambda s, d: m.bids_class(v.files(s, d).selectExpr("if(file_id % 6 = 0, name, if(file_id % 6 = 1, concat(sub, '/x', ext), if(file_id % 6 = 2, concat(path, '.eeg'), path))) as path")), [v.FILES],
    r"""SELECT path, CASE WHEN n LIKE '%.edf' AND regexp_matches(n, '^sub-\d+_ses-\d+_') THEN 'bids' WHEN n LIKE '%.edf' AND path NOT LIKE '%/%' THEN 'root_edf' WHEN n LIKE '%.edf' THEN 'unexpected_edf' WHEN n LIKE '%.eeg' THEN 'native' ELSE 'other' END AS class
    FROM (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS n FROM (SELECT CASE file_id % 6 WHEN 0 THEN name WHEN 1 THEN sub || '/x' || ext WHEN 2 THEN path || '.eeg' ELSE path END AS path FROM files))""",
)
register(
    "P7_session_discrepancy", lambda s, d: m.session_discrepancy(v.files(s, d)), [v.FILES],
    r"SELECT path, regexp_extract(path, '/ses-(\d+)', 1) AS folder_session, regexp_extract(name, 'ses-(\d+)', 1) AS name_session FROM files WHERE regexp_extract(path, '/ses-(\d+)', 1) <> regexp_extract(name, 'ses-(\d+)', 1)",
)
register("P8_recent", lambda s, d: m.recent(v.files(s, d).selectExpr("path", "mtime - 864000 as dominant", "if(file_id % 5 = 0, null, mtime) as latest"), "dominant", "latest", 1706659200, 10), [v.FILES],
    "SELECT path, mtime - 864000 AS dominant, CASE WHEN file_id % 5 = 0 THEN NULL ELSE mtime END AS latest, mtime - 864000 >= 1706659200 - 864000 OR (file_id % 5 <> 0 AND mtime >= 1706659200 - 864000) AS recent FROM files")
register(
    "A2_duration_by_day", lambda s, d: m.duration_by_day(v.scans(s, d)), [v.SCANS],
    """t AS (SELECT sub, day, count(*) AS n, round(sum(hours), 6) AS hours FROM scans GROUP BY ALL), c AS (SELECT sub, min(day) AS a, max(day) AS b FROM t GROUP BY sub),
    e AS (SELECT sub, a, b, unnest(generate_series(a::date, b::date, INTERVAL 1 DAY))::date::varchar AS day FROM c)
    SELECT sub, day, coalesce(n, 0) AS n, coalesce(hours, 0) AS hours, CASE WHEN n IS NULL THEN 'missing' WHEN hours >= 23 THEN 'good' WHEN day IN (a, b) THEN 'warn' ELSE 'err' END AS state FROM e LEFT JOIN t USING (sub, day)""",
)
register(
    "A4_find_duplicates", lambda s, d: m.find_duplicates(v.scans(s, d).selectExpr("sub", "ses", "day", "if(ses % 90 = 0, ' n/a ', duration) as duration")), [v.SCANS],
    """t AS (SELECT sub, ses, day, CASE WHEN ses % 90 = 0 THEN ' n/a ' ELSE duration END AS x FROM scans), k AS (SELECT *, CASE WHEN try_cast(trim(x) AS double) IS NULL THEN trim(x) ELSE ((round(try_cast(trim(x) AS double) * 1e6)::bigint + 500) // 1000)::varchar END AS key FROM t)
    SELECT sub, day, key, count(*) AS n, string_agg(ses::varchar, ',' ORDER BY ses) AS sessions FROM k GROUP BY ALL HAVING count(*) > 1""",
)
register("A18_subject_session_counts", lambda s, d: m.subject_session_counts(v.files(s, d)), [v.FILES], "SELECT sub, count(*) AS n_sessions FROM (SELECT DISTINCT sub, ses FROM files) GROUP BY ROLLUP (sub)")
register(
    "W2_global_sessions", lambda s, d: m.global_sessions(v.scans(s, d)), [v.SCANS],
    f"SELECT sub, ses, first, {PAD('dense_rank() OVER (PARTITION BY sub ORDER BY first, ses)')} AS global_ses FROM (SELECT sub, ses, min(acq_time) AS first FROM scans GROUP BY ALL)",
)
register(
    "W3_normalize_sessions", lambda s, d: m.normalize_sessions(v.scans(s, d).filter("ses % 3 <> 0")), [v.SCANS],
    f"SELECT sub, ses, n AS new_ses, replace(filename, 'ses-' || {PAD('ses')}, 'ses-' || {PAD('n')}) AS filename FROM (SELECT *, dense_rank() OVER (PARTITION BY sub ORDER BY ses) AS n FROM scans WHERE ses % 3 <> 0)",
)
register(
    "W4_sessions_by_study_date", lambda s, d: m.sessions_by_study_date(v.scans(s, d)), [v.SCANS],
    "SELECT sub, filename, day, dense_rank() OVER (PARTITION BY sub ORDER BY day) AS study_session, row_number() OVER (PARTITION BY sub, day ORDER BY acq_time, filename) AS study_run FROM scans",
)
register("W9_first_appearance", lambda s, d: m.first_appearance(v.demographics(s, d), "id", "idx", "last"), [v.DEMOGRAPHICS], "SELECT * FROM demographics QUALIFY row_number() OVER (PARTITION BY id ORDER BY idx DESC) = 1")
register(
    "T1_coverage_rows", lambda s, d: m.coverage_rows(v.scans(s, d).selectExpr("filename", "if(ses % 5 = 0, cast(unix_timestamp(to_timestamp(acq_time)) as string), acq_time) as acq_time", "replace(duration, '.', ',') as duration")), [v.SCANS],
    "SELECT filename AS label, epoch(acq_time::timestamp)::bigint AS start, epoch(acq_time::timestamp)::bigint + round(hours * 3600)::bigint AS stop FROM scans",
)
_ODD = "cast(ses as bigint) as row", "if(ses % 11 = 0, ' ', concat('\ufeff', filename)) as filename", "if(ses % 13 = 0, 'never', if(ses % 2 = 0, replace(acq_time, 'T', ' '), acq_time)) as acq_time", "case when ses % 17 = 0 then 'n/a' when ses % 19 = 0 then '-1,5' else replace(duration, '.', ',') end as duration"
_ODD_SQL = """SELECT ses AS "row", CASE WHEN ses % 11 = 0 THEN 'row_' || ses ELSE filename END AS label, CASE WHEN ses % 13 > 0 THEN s END AS start, CASE WHEN ses % 13 > 0 AND ses % 17 > 0 AND ses % 19 > 0 THEN s + round(hours * 3600)::bigint END AS stop,
CASE WHEN ses % 13 = 0 THEN 'bad start' WHEN ses % 17 = 0 THEN 'bad duration' WHEN ses % 19 = 0 THEN 'end before start' END AS reason FROM (SELECT *, epoch(acq_time::timestamp)::bigint AS s FROM scans)"""
register("T1_coverage_checked", lambda s, d: m.coverage_checked(v.scans(s, d).selectExpr(*_ODD)), [v.SCANS], _ODD_SQL)
register("T1_coverage_unix", lambda s, d: m.coverage_checked(v.scans(s, d).selectExpr(*_ODD).withColumn("acq_time", F.expr("if(row % 13 = 0, 'never', cast(unix_timestamp(to_timestamp(replace(acq_time, ' ', 'T'))) as string))"))), [v.SCANS], _ODD_SQL)
register(
    "T2_time_axis", lambda s, d: m.time_axis(v.sessions(s, d).selectExpr("concat(subject, '/', floor(least(s, e) / 86400) % 7) as key", "name as label", "least(s, e) as start", "greatest(s, e) as stop"), "key", 72.0), [v.SESSIONS],
    """b AS (SELECT subject || '/' || (least(s, e) // 86400) % 7 AS key, name AS label, least(s, e) AS start, greatest(s, e) AS stop FROM sessions), x AS (SELECT key, min(start) AS first, max(stop) - min(start) <= 259200 AS short FROM b GROUP BY key)
    SELECT key, label, CASE WHEN short THEN 'hours' ELSE 'days' END AS unit, round((start - first) / CASE WHEN short THEN 3600.0 ELSE 86400.0 END::double, 6) AS "offset", round((stop - start) / CASE WHEN short THEN 3600.0 ELSE 86400.0 END::double, 6) AS length FROM b JOIN x USING (key)""",
)
register(
    "T2_strip_common_prefix", lambda s, d: m.strip_common_prefix(v.files(s, d), "sub", "path"), [v.FILES],
    r"""f AS (SELECT sub, path FROM files), e AS (SELECT sub, min(path) AS lo, max(path) AS hi FROM f GROUP BY sub),
    n AS (SELECT sub, lo, max(i) AS same FROM (SELECT sub, lo, hi, unnest(range(0, length(lo) + 1)) AS i FROM e) WHERE lo[1:i] = hi[1:i] OR i = 0 GROUP BY ALL)
    SELECT sub, path, path[length(regexp_extract(lo[1:same], '^(.*/)', 1)) + 1:] AS short FROM f JOIN n USING (sub)""",
)
register(
    "T3_natural_sort", lambda s, d: m.natural_sort(v.files(s, d).selectExpr("sub", "concat('f', file_id % 300, '_', run, ext) as name").distinct(), "sub", "name"), [v.FILES],
    r"""n AS (SELECT DISTINCT sub, 'f' || (file_id % 300) || '_' || run || ext AS name FROM files)
    SELECT sub, name, row_number() OVER (PARTITION BY sub ORDER BY list_aggregate(list_transform(regexp_extract_all(name, '(\d+|\D+)'), lambda t: CASE WHEN regexp_full_match(t, '[0-9]+') THEN lpad(t, 20, '0') ELSE t END), 'string_agg', ''), name) AS place FROM n""",
)
register("T6_next_session", lambda s, d: m.next_session(v.scans(s, d)), [v.SCANS], f"SELECT sub, {PAD('max(ses) + 1')} AS next_ses FROM scans GROUP BY sub")
register(
    "T7_sort_list", lambda s, d: m.sort_list(v.files(s, d).selectExpr("sub", "concat(name, file_id) as name", "nullif(length, 0) as length"), "sub"), [v.FILES],
    "SELECT *, row_number() OVER (PARTITION BY sub ORDER BY coalesce(length, -1) DESC, name) AS place FROM (SELECT sub, name || file_id AS name, nullif(length, 0) AS length FROM files)",
)
register(
    "U1_merge_tsv", lambda s, d: u.merge_tsv(v.scans(s, d).select("sub", "ses", "filename"), v.scans(s, d).select("sub", "filename", "day")), [v.SCANS],
    "SELECT sub, ses, filename, NULL AS day FROM scans UNION ALL SELECT sub, NULL, filename, day FROM scans",
)
register(
    "U2_list_compare", lambda s, d: u.list_compare(v.files(s, d).filter("file_id % 3 <> 0"), v.files(s, d).filter("file_id % 4 <> 0"), "path"), [v.FILES],
    """a AS (SELECT DISTINCT path FROM files WHERE file_id % 3 <> 0), b AS (SELECT DISTINCT path FROM files WHERE file_id % 4 <> 0)
    SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'left' WHEN a.path IS NULL THEN 'right' ELSE 'both' END AS place FROM a FULL JOIN b ON a.path = b.path""",
)
register(
    "U3_shift_sessions", lambda s, d: u.shift_sessions(v.scans(s, d), 10, 40, 25), [v.SCANS],
    f"""t AS (SELECT sub, ses, filename, CASE WHEN ses BETWEEN 10 AND 40 THEN ses + 25 ELSE ses END AS new_ses FROM scans), r AS (SELECT sub, ses, new_ses, replace(filename, 'ses-' || {PAD('ses')}, 'ses-' || {PAD('new_ses')}) AS new_filename FROM t)
    SELECT *, count(*) OVER (PARTITION BY sub, new_filename) > 1 AS collision FROM r""",
)
register(
    "U4_swap_sessions", lambda s, d: u.edit_sessions(v.scans(s, d), "swap", 3, 7), [v.SCANS],
    f"SELECT sub, ses, n AS new_ses, replace(filename, 'ses-' || {PAD('ses')}, 'ses-' || {PAD('n')}) AS filename FROM (SELECT *, CASE ses WHEN 3 THEN 7 WHEN 7 THEN 3 ELSE ses END AS n FROM scans)",
)
register(
    "U5_import_mapping", lambda s, d: u.import_mapping(v.scans(s, d).filter("ses % 5 = 1"), v.scans(s, d).filter("ses % 4 = 2"), 4), [v.SCANS],
    """w AS (SELECT sub, ses, row_number() OVER (PARTITION BY sub ORDER BY ses) AS place FROM (SELECT DISTINCT sub, ses FROM scans WHERE ses % 5 = 1)),
    f AS (SELECT sub, n AS new_ses, row_number() OVER (PARTITION BY sub ORDER BY n) AS place FROM (SELECT DISTINCT sub FROM w) w, (SELECT unnest(range(4, 2000)) AS n) WHERE NOT EXISTS (SELECT 1 FROM scans x WHERE x.sub = w.sub AND x.ses = n AND x.ses % 4 = 2))
    SELECT sub, ses, new_ses FROM w JOIN f USING (sub, place)""",
)
register(
    "U6_rename_plan", lambda s, d: u.rename_plan(v.files(s, d)), [v.FILES],
    rf"""t AS (SELECT path, 'sub-' || {PAD('sub')} || '/ses-' || {PAD('ses')} || '/ieeg/sub-' || {PAD('sub')} || '_ses-' || {PAD('ses')} || '_' || regexp_extract(name, '_(task-[^_]+_run-\d+_.*)$', 1) AS target FROM files)
    SELECT *, count(*) OVER (PARTITION BY target) > 1 AS clash FROM t""",
)
register(
    "U7_insert_new_sessions", lambda s, d: u.insert_new_sessions(v.scans(s, d).filter("ses % 2 = 0"), v.scans(s, d).filter("ses % 3 = 0")), [v.SCANS],
    """a AS (SELECT DISTINCT sub, acq_time FROM scans WHERE ses % 2 = 0), b AS (SELECT sub, acq_time, 'existing' AS origin FROM a UNION ALL SELECT DISTINCT sub, acq_time, 'new' FROM scans WHERE ses % 3 = 0 AND (sub, acq_time) NOT IN (SELECT (sub, acq_time) FROM a))
    SELECT *, row_number() OVER (PARTITION BY sub ORDER BY acq_time) AS new_ses FROM b""",
)
register(
    "U8_copy_plan", lambda s, d: u.copy_plan(v.files(s, d).selectExpr("path"), v.files(s, d).filter("file_id % 4 <> 0"), [".pdf", ".TXT"]), [v.FILES],
    """SELECT path, 'copy/' || regexp_extract(path, '^([^/]*/[^/]*)/', 1) AS dest, CASE WHEN path IN (SELECT path FROM files WHERE file_id % 4 <> 0) THEN 'copy' ELSE 'missing' END AS state FROM files WHERE ext NOT IN ('.pdf', '.txt')""",
)
register(
    "U9_changed_sessions", lambda s, d: u.changed_sessions(v.scans(s, d).selectExpr("sub", "ses as row", "ses"), m.normalize_sessions(v.scans(s, d).filter("ses % 3 <> 0")).selectExpr("sub", "ses as row", "new_ses"), ["sub", "row"]),
    [v.SCANS], "SELECT DISTINCT sub, ses AS old_ses, n AS new_ses FROM (SELECT sub, ses, dense_rank() OVER (PARTITION BY sub ORDER BY ses) AS n FROM scans WHERE ses % 3 <> 0) WHERE ses <> n",
)

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions import phi, scalar  # noqa: E402
from tidemark.operators import events as ev  # noqa: E402

# RE2 has no Unicode word boundary: the oracle takes the character before and after as groups, and runs twice for neighbours.
_B, _E = "(^|[^0-9A-Za-z_ª-ÿ])", "($|[^0-9A-Za-z_ª-ÿ])"


_F1 = "regexp_replace(text, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}', '[REDACTED_EMAIL]', 'g')"
for _p, _r in ((r"(?:\d{1,2}[\s\-]?)?(?:\(?\d{3}\)?[\s\-]?)\d{3}[\s\-]?\d{4}", "[REDACTED_PHONE]"), (r"\d{4}-\d{2}-\d{2}", "[REDACTED_DATE]"), (r"\d{1,2}/\d{1,2}/\d{2,4}", "[REDACTED_DATE]"), (r"\d{7,}", "[REDACTED_ID]")):
    _F1 = f"regexp_replace(regexp_replace({_F1}, '{_B}{_p}{_E}', '\\1{_r}\\2', 'g'), '{_B}{_p}{_E}', '\\1{_r}\\2', 'g')"
register("F1_redact_phi", lambda s, d: v.texts(s, d).select("doc", phi.redact(F.col("text")).alias("text")), [v.TEXTS], f"SELECT doc, regexp_replace({_F1}, '[\\x00-\\x1f\\x7f]', '', 'g') AS text FROM texts")
_QUOTED = lambda x: x.replace("'", "''")
_FOUND = (
    "p AS (SELECT doc, unnest(regexp_split_to_array(text, '[^\\x20-\\x7e]+')) AS part FROM texts), h AS ("
    + " UNION ALL ".join(f"SELECT doc, '{label}' AS label, unnest(regexp_extract_all(part, '{_QUOTED(p)}', {g})) AS match FROM p WHERE length(part) > 2" for p, g, label in phi.FINDINGS)
    + f"), found AS (SELECT doc, label, match, count(*) AS n FROM h WHERE length(match) > 3 AND lower(match) NOT IN {tuple(phi.STOP_WORDS)} GROUP BY ALL)"
)
register("F2_find_phi", lambda s, d: phi.find(v.texts(s, d), "doc", "text"), [v.TEXTS], f"{_FOUND} SELECT * FROM found")
register(
    "P9_header_check", lambda s, d: phi.header_check(v.table(s, d, "customer").selectExpr("c_custkey", "case c_custkey % 7 when 0 then ' X X X X ' when 1 then c_name when 2 then 'Jane Doe' when 3 then '1.2.1980' when 4 then 'XX  X' when 5 then 'ab-1' else '' end as patient"), "patient"), [],
    r"""SELECT *, reason IS NULL AS anonymized FROM (SELECT c_custkey, patient, CASE WHEN p IN ('', 'X', 'X X X X', 'Anonymized', 'XXXX') THEN NULL WHEN regexp_matches(p, '[A-Za-z]+\s+[A-Za-z]+') THEN 'possible identifier: ' || regexp_extract(p, '[A-Za-z]+\s+[A-Za-z]+')
    WHEN regexp_matches(p, '[A-Z0-9]{6,}') THEN 'possible identifier: ' || regexp_extract(p, '[A-Z0-9]{6,}') WHEN regexp_matches(p, '\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}') THEN 'possible identifier: ' || regexp_extract(p, '\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}')
    WHEN regexp_matches(p, '^[X\s]+$') THEN NULL ELSE 'non-standard: ' || p END AS reason
    FROM (SELECT *, trim(patient) AS p FROM (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ' X X X X ' WHEN 1 THEN c_name WHEN 2 THEN 'Jane Doe' WHEN 3 THEN '1.2.1980' WHEN 4 THEN 'XX  X' WHEN 5 THEN 'ab-1' ELSE '' END AS patient FROM customer)))""",
)
register(
    "F15_normalize_text", lambda s, d: v.table(s, d, "conversations").select("conv_id", "turn", phi.normalize(F.expr(r"concat(text, if(turn % 2 = 0, '\\nend', '\r\n  x'))")).alias("text")), [],
    r"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text || CASE WHEN turn % 2 = 0 THEN '\nend' ELSE chr(13) || chr(10) || '  x' END, '\n', chr(10)), '\r\n?', chr(10), 'g'), '[^\x20-\x7e\n]', ' ', 'g'), ' +', ' ', 'g'), ' ?\n ?', chr(10), 'g')) AS text FROM conversations""",
)
register(
    "F16_partition_label", lambda s, d: v.table(s, d, "part").select("p_partkey", *[c.alias(n) for c, n in zip(phi.partition_label(F.expr("concat(substring(p_name, 1, 2), p_partkey % 30, if(p_partkey % 4 = 0, 'x2', ''))")), ("grp", "number"), strict=True)]), [],
    r"SELECT p_partkey, regexp_extract(x, '^([A-Za-z]+)', 1) AS grp, nullif(regexp_extract(x, '^[A-Za-z]+(\d+)', 1), '')::int AS number FROM (SELECT p_partkey, substr(p_name, 1, 2) || (p_partkey % 30) || CASE WHEN p_partkey % 4 = 0 THEN 'x2' ELSE '' END AS x FROM part)",
)
_PEOPLE = lambda s, d: v.table(s, d, "customer").selectExpr("concat('Fn', c_custkey % 40) as firstname", "if(c_custkey % 9 = 0, null, concat('Ln', c_custkey % 70)) as lastname")
register(
    "S14_names_dictionary", lambda s, d: phi.name_variants(_PEOPLE(s, d), ["", " ", "_", "-", ", "]), [],
    """p AS (SELECT DISTINCT 'Fn' || (c_custkey % 40) AS f, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'Ln' || (c_custkey % 70) END AS l FROM customer), s AS (SELECT unnest(['', ' ', '_', '-', ', ']) AS s),
    n AS (SELECT unnest([f, l, f || s || l, l || s || f, f[1:1] || s || l, f || s || l[1:1]]) AS name FROM p, s) SELECT DISTINCT name FROM n WHERE name IS NOT NULL""",
)
register(
    "F12_scrub_header", lambda s, d: v.table(s, d, "customer").select("c_custkey", *[c.alias(n) for c, n in zip(phi.scrub_header(F.col("c_name"), F.expr("if(c_custkey % 2 = 0, 'Startdate 01-JAN-2020', 'x')"), F.expr("c_custkey % 3 = 0")), ("patient", "recording"), strict=True)]), [],
    "SELECT c_custkey, rpad(CASE WHEN c_custkey % 3 = 0 THEN 'X X X X' ELSE '' END, 80, ' ') AS patient, rpad(CASE WHEN c_custkey % 3 = 0 OR c_custkey % 2 = 0 THEN 'Startdate X X X X' ELSE '' END, 80, ' ') AS recording FROM customer",
)
_FIELDS = "if(c_custkey % 4 = 0, c_name, concat('MCH-', c_custkey, ' F 02-MAY-1951  Haagse_', c_custkey, if(c_custkey % 3 = 0, ' more words', ''))) as patient", "if(c_custkey % 5 = 0, 'x', concat('Startdate 02-MAR-2002 PSG-', c_custkey, ' NN Telemetry03')) as recording"
register(
    "F12_scrub_subfields", lambda s, d: v.table(s, d, "customer").selectExpr("c_custkey", *_FIELDS).select("c_custkey", *[c.alias(n) for c, n in zip(phi.scrub_subfields(F.col("patient"), F.col("recording"), {"sex", "equipment", "additional"}), ("patient", "recording"), strict=True)]), [],
    "SELECT c_custkey, rpad(CASE WHEN c_custkey % 4 = 0 THEN 'X X X X' ELSE 'X F X X' || CASE WHEN c_custkey % 3 = 0 THEN ' more words' ELSE '' END END, 80, ' ') AS patient, rpad(CASE WHEN c_custkey % 5 = 0 THEN 'Startdate X X X X' ELSE 'Startdate X X X Telemetry03' END, 80, ' ') AS recording FROM customer",
)
register(
    "F18_uuid_from_name", lambda s, d: v.table(s, d, "customer").select("c_custkey", phi.uuid_from_name(F.expr("case c_custkey % 3 when 0 then concat('rec_', regexp_replace(md5(cast(c_name as binary)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5'), '.x') when 1 then concat(c_name, ' (', c_custkey % 5, ').edf') else c_name end")).alias("id")), [],
    r"SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN regexp_replace(md5(c_name), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') WHEN 1 THEN c_name || '.edf' ELSE c_name END AS id FROM customer",
)
register(
    "F21_overwrite_annotations", lambda s, d: phi.overwrite(v.events_tsv(s, d), "text", [("click note", "exact", ""), ("^view", "match", "seen"), ("ERROR", "remove", "")]), [v.EVENTS_TSV],
    "SELECT *, CASE WHEN text LIKE '%click note%' THEN replace(text, 'click note', 'XXXXXXXXXX') WHEN text LIKE 'view%' THEN 'seen' WHEN text ILIKE '%error%' THEN '' ELSE text END AS new_text FROM events_tsv",
)
register(
    "N1_excel_serial", lambda s, d: v.table(s, d, "events").select("event_id", scalar.excel_serial(F.expr("if(event_id % 50 = 0, 90000.5D, 45292.0D + event_id / 64.0D)")).alias("moment")), [],
    "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '90000.5' ELSE strftime(make_timestamp(((45292.0 + event_id / 64.0 - 25569) * 86400e6)::bigint), '%Y-%m-%d %H:%M:%S.%f') END AS moment FROM events",
)
register(
    "N2_parse_edf_datetime", lambda s, d: v.table(s, d, "orders").select("o_orderkey", scalar.edf_datetime(F.date_format("o_orderdate", "dd.MM.yy"), F.expr("concat(lpad(o_orderkey % 24, 2, '0'), '.', lpad(o_orderkey % 60, 2, '0'), '.07')")).alias("start")), [],
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad((o_orderkey % 24)::varchar, 2, '0') || ':' || lpad((o_orderkey % 60)::varchar, 2, '0') || ':07' AS start FROM orders",
)
register(
    "N3_sec2time", lambda s, d: v.table(s, d, "orders").select("o_orderkey", scalar.sec2time(F.expr("cast(o_orderkey * 123456789 - 500000000000 as bigint)")).alias("t")), [],
    """SELECT o_orderkey, CASE WHEN x < 0 THEN '-' ELSE '' END || CASE WHEN abs(x) // 86400000000 > 0 THEN (abs(x) // 86400000000) || ' days, ' ELSE '' END || printf('%02d:%02d:%02d.%06d', abs(x) % 86400000000 // 3600000000, abs(x) // 60000000 % 60, abs(x) // 1000000 % 60, abs(x) % 1000000) AS t
    FROM (SELECT o_orderkey, o_orderkey * 123456789 - 500000000000 AS x FROM orders)""",
)
register(
    "N4_record_range", lambda s, d: v.table(s, d, "orders").select("o_orderkey", *[c.alias(n) for c, n in zip(scalar.record_range(F.expr("o_orderkey % 5000"), F.lit(10), F.lit(28800), F.expr("o_orderkey * 7 % 86400"), F.expr("o_orderkey * 11 % 86400"), 5, 5), ("rec_from", "rec_to", "why"), strict=True)]), [],
    """r AS (SELECT o_orderkey, a, b, greatest(floor((a - 300 - 28800) / 10), 0)::bigint AS f, least(ceil((b + 300 - 28800) / 10), o_orderkey % 5000)::bigint AS t FROM (SELECT o_orderkey, o_orderkey * 7 % 86400 AS a, o_orderkey * 11 % 86400 AS b FROM orders)),
    w AS (SELECT *, CASE WHEN b <= a THEN 'end before start' WHEN t <= f THEN 'outside the recording' END AS why FROM r) SELECT o_orderkey, CASE WHEN why IS NULL THEN f END AS rec_from, CASE WHEN why IS NULL THEN t END AS rec_to, why FROM w""",
)
register("N6_date_offset", lambda s, d: v.table(s, d, "orders").select("o_orderkey", scalar.date_offset(F.to_date("o_orderdate")).cast("string").alias("shifted")), [], "SELECT o_orderkey, (o_orderdate::date - 5856)::varchar AS shifted FROM orders")
register(
    "N7_age_years", lambda s, d: v.table(s, d, "orders").select("o_orderkey", scalar.age_years(F.expr("if(o_orderkey % 13 = 0, null, date_sub(to_date(o_orderdate), cast(o_orderkey * 37 % 36500 as int)))"), F.to_date("o_orderdate")).alias("age")), [],
    "SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'X' WHEN (o_orderkey * 37 % 36500) // 365 >= 89 THEN '89+' ELSE ((o_orderkey * 37 % 36500) // 365)::varchar END AS age FROM orders",
)
register(
    "N8_prefilter_cutoffs", lambda s, d: v.table(s, d, "part").select("p_partkey", *[c.alias(n) for c, n in zip(scalar.prefilter_cutoffs(F.expr("concat(if(p_partkey % 3 = 0, '', concat('hp: 0.', p_partkey % 9, ' ')), 'LP:', p_size, 'Hz')")), ("high_pass", "low_pass"), strict=True)]), [],
    "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE ('0.' || (p_partkey % 9))::double END AS high_pass, p_size::double AS low_pass FROM part",
)
register("N14_duration_units", lambda s, d: v.table(s, d, "orders").select("o_orderkey", F.round(scalar.ticks_to_seconds(F.col("o_orderkey") * 123457), 7).alias("seconds"), F.round(scalar.ticks_to_seconds(F.col("o_orderkey") * 123457) / 3600, 9).alias("hours")), [], "SELECT o_orderkey, round(o_orderkey * 123457 / 1e7, 7) AS seconds, round(o_orderkey * 123457 / 1e7 / 3600, 9) AS hours FROM orders")
register(
    "S12_parse_size", lambda s, d: v.table(s, d, "part").selectExpr("p_partkey", "concat(p_size, '.5 ', element_at(array('b', 'kb', 'MiB', 'GB', 'zz'), cast(p_partkey % 5 as int) + 1)) as x").select("p_partkey", scalar.parse_size(F.col("x")).alias("bytes"), scalar.format_size(scalar.parse_size(F.col("x"))).alias("shown")), [],
    """b AS (SELECT p_partkey, round((p_size + 0.5) * (CASE p_partkey % 5 WHEN 1 THEN 1024 WHEN 2 THEN 1048576 WHEN 3 THEN 1073741824 ELSE 1 END))::bigint AS bytes FROM part)
    SELECT p_partkey, bytes, CASE WHEN bytes < 1024 THEN printf('%d B', bytes) WHEN bytes < 1048576 THEN printf('%.1f KB', floor(bytes * 10 / 1024 + 0.5) / 10) WHEN bytes < 1073741824 THEN printf('%.1f MB', floor(bytes * 10 / 1048576 + 0.5) / 10) ELSE printf('%.1f GB', floor(bytes * 10 / 1073741824 + 0.5) / 10) END AS shown FROM b""",
)
register(
    "S13_demographics", lambda s, d: v.demographics(s, d).select("idx", "id", scalar.normal_age(F.col("age")).alias("age"), scalar.normal_sex(F.col("sex")).alias("sex"), F.coalesce(F.nullif("grp", F.lit("")), F.lit("patient")).alias("grp")), [v.DEMOGRAPHICS],
    "SELECT idx, id, try_cast(age AS int) AS age, CASE WHEN lower(trim(sex)) IN ('m', 'male', 'man', '1') THEN 'm' WHEN lower(trim(sex)) IN ('f', 'female', 'woman', '0') THEN 'f' ELSE lower(trim(sex)) END AS sex, coalesce(nullif(grp, ''), 'patient') AS grp FROM demographics",
)

_LINES = "concat(if(seq % 17 = 0, '# ', ''), if(seq % 23 = 0, '', concat(cast(seq as string), if(seq % 29 = 0, '', '\\t'), text))) as line"
register(
    "P1_prune_events", lambda s, d: ev.prune_events(v.events_tsv(s, d).selectExpr("rec", _LINES), 2), [v.EVENTS_TSV],
    """l AS (SELECT rec, CASE WHEN seq % 17 = 0 THEN '# ' ELSE '' END || CASE WHEN seq % 23 = 0 THEN '' ELSE seq || CASE WHEN seq % 29 = 0 THEN '' ELSE chr(9) END || text END AS line FROM events_tsv)
    SELECT rec, CASE WHEN line LIKE '#%' THEN 'comment' WHEN trim(line) = '' THEN 'blank' WHEN len(string_split(line, chr(9))) <> 2 THEN 'columns' WHEN trim(regexp_replace(string_split(line, chr(9))[-1], '[^\\x20-\\x7e]', '', 'g')) = '' THEN 'empty' ELSE 'kept' END AS reason, count(*) AS n FROM l GROUP BY ALL""",
)
_CH = "element_at(array('LA', 'C', 'dc', 'Pr', 'Photic', ' RH', '', 'osat'), cast(p_partkey % 8 as int) + 1)"
register(
    "P4_evoked_channels", lambda s, d: ev.evoked_channels(v.table(s, d, "part").selectExpr("p_size as rec", f"if(p_partkey % 8 = 6, '', concat({_CH}, p_partkey % 20)) as label"), "rec", "label"), [],
    """SELECT DISTINCT p_size AS rec, trim((['LA', 'C', 'dc', 'Pr', 'Photic', ' RH', '', 'osat'])[(p_partkey % 8 + 1)::int] || (p_partkey % 20)) AS channel FROM part WHERE p_partkey % 8 IN (0, 5)""",
)
_LABELLED = r"""lab AS (SELECT rec, seq, onset, CASE WHEN text LIKE 'Stim St%' THEN 'rev3' ELSE 'rev2' END AS decoder,
CASE WHEN text LIKE 'Stim St%' THEN regexp_extract(text, 'Start (\S+) ', 1) ELSE regexp_extract(text, 'from (\S+)', 1) || '-' || regexp_extract(text, ' to (\S+)', 1) END AS pair,
CASE WHEN text LIKE 'Stim St%' THEN regexp_extract(text, '([\d.]+)$', 1) ELSE coalesce(nullif(regexp_extract(text, 'current=(\d+)', 1), ''), 'unknown') END AS current FROM events_tsv WHERE text LIKE 'Stim St%' OR text LIKE 'Start Stimulation%')"""
_RELAY = r"""rel0 AS (SELECT *, CASE WHEN text LIKE 'Closed relay%' THEN regexp_extract(text, 'to (\S+)', 1) || '-' || regexp_extract(text, 'and (\S+)', 1) WHEN text LIKE 'Opened relay%' THEN '' END AS change FROM events_tsv),
rel AS (SELECT rec, seq, onset, 'rev1' AS decoder, pair, text AS current FROM (SELECT *, last_value(change IGNORE NULLS) OVER (PARTITION BY rec ORDER BY seq ROWS UNBOUNDED PRECEDING) AS pair FROM rel0) WHERE regexp_full_match(text, '\d+') AND pair <> '')"""
register("F17_stim_labels", lambda s, d: ev.labelled(v.events_tsv(s, d)), [v.EVENTS_TSV], f"{_LABELLED} SELECT * FROM lab")
register("W6_relay_state", lambda s, d: ev.relay_state(v.events_tsv(s, d)), [v.EVENTS_TSV], f"{_RELAY} SELECT * FROM rel")
_SUMMARY = f"""{_LABELLED}, {_RELAY}, al AS (SELECT *, CASE decoder WHEN 'rev3' THEN 1 WHEN 'rev2' THEN 2 ELSE 3 END AS rank FROM (SELECT * FROM lab UNION ALL SELECT * FROM rel)),
bst AS (SELECT * FROM al JOIN (SELECT rec, min(rank) AS rank FROM al GROUP BY rec) USING (rec, rank)), en AS (SELECT rec, decoder, current, split_part(pair, '-', 1) AS a, split_part(pair, '-', 2) AS b FROM bst UNION ALL SELECT rec, decoder, current, split_part(pair, '-', 2), split_part(pair, '-', 1) FROM bst),
summary AS (SELECT rec, decoder, a AS electrode, string_agg(DISTINCT b, ',' ORDER BY b) AS partners, string_agg(DISTINCT current, ',' ORDER BY current) AS currents FROM en GROUP BY ALL)"""
_SOME = "(rec % 3 = 0 or text not like 'Stim St%') and (rec % 3 <> 2 or text not like 'Start St%')"
register("A12_ccep_summary", lambda s, d: ev.ccep_summary(v.events_tsv(s, d).withColumn("text", F.expr(f"if({_SOME}, text, 'note')"))), [v.EVENTS_TSV], f"some_events AS (SELECT rec, seq, onset, CASE WHEN {_SOME} THEN text ELSE 'note' END AS text FROM events_tsv), " + _SUMMARY.replace("events_tsv", "some_events") + " SELECT * FROM summary")
_ELECTRODES = ["A1", "A2", "A3", "A4", "A5", "A6", "A7", "A8", "B1", "LA1"]
register(
    "A13_stim_matrix", lambda s, d: ev.stim_matrix(ev.ccep_summary(v.events_tsv(s, d)), _ELECTRODES), [v.EVENTS_TSV],
    f"{_SUMMARY}, c AS (SELECT electrode, unnest(string_split(currents, ',')) AS current FROM summary) SELECT current, " + ", ".join(f"coalesce(max(CASE WHEN electrode = '{e}' THEN '✓' END), '') AS {e}" for e in _ELECTRODES) + " FROM c GROUP BY current",
)
register(
    "W5_manual_stims", lambda s, d: ev.manual_stims(v.events_tsv(s, d), 36000.0), [v.EVENTS_TSV],
    r"""t AS (SELECT *, regexp_matches(text, '^(Closed relay to|Start Stimulation from) ') AS command, lower(text) LIKE '%high freq%' AS high FROM events_tsv),
    x AS (SELECT *, lag(high, 1, false) OVER w AS hb, lead(onset) OVER w AS nxt, sum(command::int) OVER (PARTITION BY rec ORDER BY seq ROWS UNBOUNDED PRECEDING) AS block FROM t WINDOW w AS (PARTITION BY rec ORDER BY seq)),
    g AS (SELECT rec, block, max(CASE WHEN command AND NOT high AND NOT hb AND nxt - onset < 36000 THEN seq END) AS seq, max(CASE WHEN command THEN regexp_extract(text, ' (?:to|from) (\S+)', 1) || '-' || regexp_extract(text, '(\S+)(?: current.*)?$', 1) END) AS pair,
    coalesce(string_agg(DISTINCT CASE WHEN NOT command AND NOT regexp_matches(text, '[A-Za-z]+\d+') THEN nullif(regexp_extract(text, '(\d+(?:\.\d+)?)', 1), '') END, ',' ORDER BY CASE WHEN NOT command AND NOT regexp_matches(text, '[A-Za-z]+\d+') THEN nullif(regexp_extract(text, '(\d+(?:\.\d+)?)', 1), '') END), '') AS currents FROM x WHERE block > 0 GROUP BY ALL)
    SELECT rec, seq, pair, currents FROM g WHERE seq IS NOT NULL""",
)
register("A25_recording_bounds", lambda s, d: ev.recording_bounds(v.events_tsv(s, d)), [v.EVENTS_TSV], "SELECT rec, min_by(onset, seq) AS first_onset, max_by(onset, seq) AS last_onset, count(*) AS n FROM events_tsv GROUP BY rec")
_TIMED = "cast(round(onset * 1000000) as bigint) + 1704067200000000"
register(
    "A25_bounds_report", lambda s, d: ev.bounds_report(v.events_tsv(s, d).withColumn("time", F.expr(f"if(rec % 3 > 0 and seq % 5 > 0, timestamp_micros({_TIMED}), null)"))), [v.EVENTS_TSV],
    f"""t AS (SELECT *, CASE WHEN rec % 3 > 0 AND seq % 5 > 0 THEN make_timestamp({_TIMED}) END AS time FROM events_tsv),
    e AS (SELECT rec, min_by(time, seq) FILTER (time IS NOT NULL) AS t0, max_by(time, seq) FILTER (time IS NOT NULL) AS t1, min_by(onset, seq)::decimal(20, 6)::varchar AS o0, max_by(onset, seq)::decimal(20, 6)::varchar AS o1 FROM t GROUP BY rec)
    SELECT rec, coalesce(strftime(t0, '%Y-%m-%d %H:%M:%S'), regexp_replace(rtrim(o0, '0'), '[.]$', '.0') || ' s') AS first, coalesce(strftime(t1, '%Y-%m-%d %H:%M:%S'), regexp_replace(rtrim(o1, '0'), '[.]$', '.0') || ' s') AS last,
    coalesce(strftime(t0, '%Y-%m-%d') || chr(9) || ltrim(strftime(t0, '%I:%M:%S %p'), '0') || chr(9) || ltrim(strftime(t1, '%I:%M:%S %p'), '0'), 'N/A') AS row FROM e""",
)
register(
    "A17_estimate_rate", lambda s, d: ev.estimate_rate(v.events_tsv(s, d).selectExpr("rec", "seq", "onset / 400 as onset", "cast(seq * 1000 as bigint) as stamp"), "stamp"), [v.EVENTS_TSV],
    """x AS (SELECT rec, (seq - lag(seq) OVER w) * 1000 AS ds, onset / 400 - lag(onset / 400) OVER w AS dt FROM events_tsv WINDOW w AS (PARTITION BY rec ORDER BY seq)), r AS (SELECT rec, CASE WHEN ds > 0 AND dt BETWEEN 0.5 AND 60 THEN ds / dt END AS ratio FROM x)
    SELECT rec, count(ratio) AS n, round(CASE WHEN count(ratio) >= 30 THEN quantile_cont(ratio, 0.5) END, 6) AS rate FROM r GROUP BY rec""",
)
register(
    "R7_event_sessions_batch", lambda s, d: ev.event_sessions(v.events_tsv(s, d), 36000.0), [v.EVENTS_TSV],
    """x AS (SELECT *, coalesce(onset - lag(onset) OVER (PARTITION BY rec ORDER BY seq) >= 36000, true)::int AS new FROM events_tsv), b AS (SELECT *, sum(new) OVER (PARTITION BY rec ORDER BY seq ROWS UNBOUNDED PRECEDING) AS burst FROM x)
    SELECT rec, start, stop, n FROM (SELECT rec, burst, min(onset) AS start, max(onset) AS stop, count(*) AS n FROM b GROUP BY ALL)""",
)
_SHORT = "regexp_extract(text, '^([a-z]+ note [0-9])', 1)"
register(
    "J5_complete_truncated", lambda s, d: ev.complete_truncated(v.events_tsv(s, d).filter("seq % 3 = 0 and text like '% note %'").selectExpr("rec", "seq", "onset", f"{_SHORT} as text"), v.events_tsv(s, d).filter("seq % 3 <> 0 and text like '% note %'")), [v.EVENTS_TSV],
    f"""a AS (SELECT rec, seq, onset, {_SHORT} AS short, row_number() OVER (PARTITION BY rec, {_SHORT} ORDER BY seq) AS i, count(*) OVER (PARTITION BY rec, {_SHORT}) AS n FROM events_tsv WHERE seq % 3 = 0 AND text LIKE '% note %'),
    c AS (SELECT k.rec, k.short, e.seq AS note_seq, e.onset AS note_onset, e.text AS "full", row_number() OVER (PARTITION BY k.rec, k.short ORDER BY e.seq) AS j, count(*) OVER (PARTITION BY k.rec, k.short) AS m
    FROM (SELECT DISTINCT rec, short FROM a) k JOIN events_tsv e ON e.rec = k.rec AND e.seq % 3 <> 0 AND e.text LIKE '% note %' AND starts_with(e.text, k.short) AND length(e.text) > length(k.short)),
    s AS (SELECT a.*, c.j - a.i AS s, c.note_seq, c.note_onset, c."full" FROM a JOIN c ON a.rec = c.rec AND a.short = c.short AND c.j >= a.i AND c.j - a.i <= c.m - a.n),
    d AS (SELECT *, power((onset - min_by(onset, i) OVER w) - (note_onset - min_by(note_onset, i) OVER w), 2) AS dd FROM s WINDOW w AS (PARTITION BY rec, short, s)),
    q AS (SELECT rec, short, s, round(sum(dd), 6) AS score FROM d GROUP BY rec, short, s QUALIFY row_number() OVER (PARTITION BY rec, short ORDER BY score, s) = 1)
    SELECT d.rec, d.seq, d.short, d.note_seq, d."full" FROM d JOIN q ON d.rec = q.rec AND d.short = q.short AND d.s = q.s""",
)

from tidemark.operators import dataset as ds  # noqa: E402
from tidemark.operators import filters as fl  # noqa: E402
from tidemark.operators import joins as j  # noqa: E402
from tidemark.operators import signals as sg  # noqa: E402

register(
    "A1_folder_stats", lambda s, d: ds.folder_stats(v.files(s, d)), [v.FILES],
    """p AS (SELECT sub, ses, mtime // 86400 AS day, count(*) AS n FROM files GROUP BY ALL), t AS (SELECT *, row_number() OVER (PARTITION BY sub, ses ORDER BY n DESC, day) AS k FROM p),
    f AS (SELECT sub, ses, count(*) AS n_files, sum(length)::bigint AS bytes, max(mtime) AS latest, bool_or(ext = '.edf') AS has_native FROM files GROUP BY ALL)
    SELECT f.*, t.day AS dominant_day, t.n AS dominant_n, round(t.n / n_files, 6) AS share FROM f JOIN t USING (sub, ses) WHERE k = 1""",
)
register(
    "A5_duplicate_content", lambda s, d: ds.duplicate_content(v.files(s, d).withColumn("sub", F.expr("file_id % 200"))), [v.FILES],
    """g AS (SELECT file_id % 200 AS sub, ses, ext, length, md5 FROM files), n AS (SELECT sub, count(DISTINCT ses) AS sessions FROM g GROUP BY sub), e AS (SELECT sub, ext, ses, string_agg(length || ':' || coalesce(md5, ''), ',' ORDER BY length, coalesce(md5, '')) AS content, min(length) AS least FROM g GROUP BY ALL)
    SELECT sub, ext, CASE WHEN count(*) < any_value(sessions) THEN 'missing' WHEN count(DISTINCT content) = 1 AND min(least) > 0 THEN 'match' ELSE 'differ' END AS state FROM e JOIN n USING (sub) GROUP BY sub, ext""",
)
register(
    "A6_duplicate_runs", lambda s, d: ds.duplicate_runs(v.files(s, d).withColumns({"run": F.col("file_id"), "ext": F.lit(".edf")})), [v.FILES],
    """k AS (SELECT sub, ses, file_id AS run, count(*) AS n, CASE WHEN bool_or(md5 IS NULL) THEN 'x' || file_id ELSE string_agg(md5, ',' ORDER BY md5) END AS key FROM files GROUP BY sub, ses, file_id)
    SELECT sub, ses, run, n, CASE WHEN row_number() OVER (PARTITION BY key ORDER BY n DESC, sub, ses, run) = 1 THEN 'primary' ELSE 'skip' END AS role, count(*) OVER (PARTITION BY key) AS copies FROM k""",
)
register(
    "A7_duplicate_sessions", lambda s, d: ds.duplicate_sessions(v.files(s, d)), [v.FILES],
    """SELECT file_id, CASE WHEN md5 IS NOT NULL AND row_number() OVER (PARTITION BY length, md5 ORDER BY file_id) > 1 THEN 'skip' ELSE 'keep' END AS action, CASE WHEN md5 IS NULL THEN file_id ELSE min(file_id) OVER (PARTITION BY length, md5) END AS first_id FROM files""",
)
register(
    "A8_dedupe_keep_largest", lambda s, d: ds.dedupe_keep_largest(v.files(s, d).selectExpr("concat('f', file_id % 100, if(file_id % 3 = 0, '', concat(' (', file_id % 4, ')'))) as name", "if(file_id % 37 = 0, null, length) as length")), [v.FILES],
    """n AS (SELECT 'f' || (file_id % 100) || CASE WHEN file_id % 3 = 0 THEN '' ELSE ' (' || (file_id % 4) || ')' END AS name, CASE WHEN file_id % 37 = 0 THEN NULL ELSE length END AS length FROM files)
    SELECT regexp_replace(name, ' \\([^(]*$', '') AS base, name, length FROM n WHERE length IS NULL OR length > 0 QUALIFY row_number() OVER (PARTITION BY regexp_replace(name, ' \\([^(]*$', '') ORDER BY length DESC NULLS LAST, name) = 1""",
)
_ISSUES = """CASE WHEN NOT bool_or(ext IN ('.edf', '.edf.gz')) THEN 'no container' END, CASE WHEN count(*) FILTER (ext = '.edf.gz') > 1 THEN 'several archives' END, CASE WHEN NOT bool_or(ext = '.tsv') THEN 'no events' END, CASE WHEN NOT bool_or(ext = '.json') THEN 'no json' END,
CASE WHEN bool_or(ext IN ('.edf', '.edf.gz')) AND NOT bool_or(ext = '.md5') THEN 'no checksum' END, CASE WHEN bool_or(ext = '.edf') AND bool_or(ext = '.edf.gz') THEN 'raw and archive' END"""
register("A9_validate_session", lambda s, d: ds.validate_session(v.files(s, d)), [v.FILES], f"SELECT sub, ses, count(*) AS n_files, concat_ws('; ', {_ISSUES}) AS issues, concat_ws('; ', {_ISSUES}) = '' AS ok FROM files GROUP BY sub, ses")
register(
    "D5_rule_set", lambda s, d: ds.validate_session(v.files(s, d), {k: ds.RULES[k] for k in ("no json", "no events")}), [v.FILES],
    "SELECT sub, ses, count(*) AS n_files, concat_ws('; ', CASE WHEN NOT bool_or(ext = '.json') THEN 'no json' END, CASE WHEN NOT bool_or(ext = '.tsv') THEN 'no events' END) AS issues, bool_or(ext = '.json') AND bool_or(ext = '.tsv') AS ok FROM files GROUP BY sub, ses",
)
register(
    "A10_dataset_summary", lambda s, d: ds.dataset_summary(v.scans(s, d), v.files(s, d).withColumn("length", F.col("length") * 100000)), [v.SCANS, v.FILES],
    """z AS (SELECT sub, ses, sum(length * 100000)::bigint AS bytes FROM files GROUP BY ALL) SELECT sub, ses, filename, day, hours, (bytes * 1000 + 536870912) // 1073741824 / 1000.0::double AS gb, CASE WHEN bytes IS NULL THEN 'folder missing' ELSE '' END AS error FROM scans LEFT JOIN z USING (sub, ses)""",
)
_PACKED = "unhex(concat('1f8b00', regexp_replace(lpad(hex(length * 3 + file_id % 7), 8, '0'), '(..)(..)(..)(..)', '$4$3$2$1')))"
register(
    "A11_compression_ratio", lambda s, d: ds.compression_ratio(v.files(s, d).withColumn("unpacked", edf.gzip_size(F.expr(f"if(ext = '.edf.gz' and file_id % 5 > 0, {_PACKED}, null)")))), [v.FILES],
    "SELECT *, round(stored / nullif(unpacked, 0), 6) AS ratio FROM (SELECT sub, sum(length)::bigint AS stored, coalesce(sum(CASE WHEN ext <> '.edf.gz' THEN length WHEN file_id % 5 > 0 THEN length * 3 + file_id % 7 END), 0)::bigint AS unpacked FROM files GROUP BY sub)",
)
register("A16_anonymisation_report", lambda s, d: ds.anonymisation_report(v.files(s, d).selectExpr("if(file_id % 19 = 0, null, file_id % 3 <> 0) as header_ok", "file_id % 5 <> 0 as notes_ok")), [v.FILES],
    "SELECT CASE WHEN file_id % 19 = 0 THEN 'ERROR' WHEN file_id % 3 <> 0 AND file_id % 5 <> 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n FROM files GROUP BY ALL")
_CHECKED = lambda s, d: v.files(s, d).selectExpr("cast(file_id as string) as path", "if(file_id % 19 = 0, null, file_id % 3 <> 0) as header_ok", "file_id % 5 <> 0 as notes_ok", "if(file_id % 5 = 0, concat('text: note ', file_id % 7, '; text: x'), null) as findings")
register(
    "A16_anonymisation_issues", lambda s, d: ds.anonymisation_issues(_CHECKED(s, d)), [v.FILES],
    """i AS (SELECT file_id::varchar AS path, CASE WHEN file_id % 19 = 0 THEN 'ERROR' ELSE 'FAIL' END AS status, list_filter([CASE WHEN file_id % 19 = 0 THEN 'header not checked' WHEN file_id % 3 = 0 THEN 'header not anonymised' END, CASE WHEN file_id % 5 = 0 THEN 'annotations not anonymised' END,
    CASE WHEN file_id % 5 = 0 THEN 'text: note ' || (file_id % 7) END, CASE WHEN file_id % 5 = 0 THEN 'text: x' END], lambda x: x IS NOT NULL) AS x FROM files WHERE file_id % 19 = 0 OR file_id % 3 = 0 OR file_id % 5 = 0)
    SELECT path, status, (generate_subscripts(x, 1) - 1)::int AS place, unnest(x) AS issue FROM i""",
)
register("A19_checksum", lambda s, d: ds.checksum(v.files(s, d).withColumn("md5", F.expr("if(file_id % 43 = 0, 'bad', md5)"))), [v.FILES],
    "SELECT file_id, coalesce(CASE WHEN file_id % 43 = 0 THEN 'bad' ELSE md5 END, md5(text)) AS md5, sha256(text) AS sha256, CASE WHEN file_id % 43 = 0 THEN 'diff' WHEN md5 IS NULL THEN 'computed' ELSE 'equal' END AS state FROM files")
_EMPTY = "SELECT sub, ses, coalesce(n, 0) AS others FROM (SELECT DISTINCT o_custkey % 20 AS sub, o_orderkey % 10 AS ses FROM orders) LEFT JOIN (SELECT sub, ses, count(*) FILTER (ext IN ('.edf', '.tsv', '.edf.gz')) AS useful, count(*) AS n FROM files GROUP BY ALL) USING (sub, ses) WHERE coalesce(useful, 0) = 0"
_SESSION_LIST = lambda s, d: v.table(s, d, "orders").selectExpr("o_custkey % 20 as sub", "o_orderkey % 10 as ses").distinct()
register("A21_empty_sessions", lambda s, d: ds.empty_sessions(_SESSION_LIST(s, d), v.files(s, d)), [v.FILES], _EMPTY)
_ORPHANS = r"""SELECT file_id, name FROM files WHERE ext IN ('.json', '.tsv', '.md5') AND regexp_extract(name, '^(sub-\d+_ses-\d+_task-[^_]+_run-\d+)', 1) NOT IN (SELECT regexp_extract(name, '^(sub-\d+_ses-\d+_task-[^_]+_run-\d+)', 1) FROM files WHERE ext IN ('.edf', '.edf.gz'))"""
register("A22_orphan_sidecars", lambda s, d: ds.orphan_sidecars(v.files(s, d)), [v.FILES], _ORPHANS)
_COPIES = """k AS (SELECT sub, ses, day, CASE WHEN try_cast(trim(duration) AS double) IS NULL THEN trim(duration) ELSE ((round(try_cast(trim(duration) AS double) * 1e6)::bigint + 500) // 1000)::varchar END AS key FROM {scans}),
sc AS (SELECT sub, ses, CASE WHEN bool_or(md5 IS NULL) THEN NULL ELSE string_agg(ext || ':' || length || ':' || md5, ',' ORDER BY ext, length, md5) END AS content FROM {files} GROUP BY ALL),
cp AS (SELECT k.sub, day, key, count(*) AS n, count(DISTINCT content) = 1 AND count(content) = count(*) AS "full" FROM k LEFT JOIN sc USING (sub, ses) WHERE {on} GROUP BY ALL HAVING count(*) > 1)"""
_FEW_KINDS = lambda s, d: v.scans(s, d).filter("ses <= 8").withColumn("duration", F.expr("cast(ses % 3 as string)"))
_FINDINGS = rf"""{_COPIES.format(scans="scans", files="files", on="true")}, sl AS (SELECT DISTINCT o_custkey % 20 AS sub, o_orderkey % 10 AS ses FROM orders), ms AS (SELECT DISTINCT sub, ses FROM scans),
dr AS (SELECT sub, ses, run, CASE WHEN bool_or(md5 IS NULL) THEN 'x' || sub || '/' || ses || '/' || run ELSE string_agg(ext || md5, ',' ORDER BY ext, md5) END AS key, count(*) AS n FROM files GROUP BY sub, ses, run),
iss AS (SELECT sub, ses, concat_ws('; ', {_ISSUES}) AS i FROM files GROUP BY sub, ses),
x AS (SELECT 'missing_folder' AS check, sub, 'ses-' || lpad(ses::varchar, 3, '0') AS item FROM ms ANTI JOIN sl USING (sub, ses) UNION ALL SELECT 'extra_folder', sub, 'ses-' || lpad(ses::varchar, 3, '0') FROM sl ANTI JOIN ms USING (sub, ses)
UNION ALL SELECT 'session_discrepancy', sub, path FROM files WHERE regexp_extract(path, '/ses-(\d+)', 1) <> regexp_extract(name, 'ses-(\d+)', 1) UNION ALL SELECT 'empty_session', sub, 'ses-' || lpad(ses::varchar, 3, '0') FROM ({_EMPTY})
UNION ALL SELECT 'orphan_sidecar', f.sub, o.name FROM ({_ORPHANS}) o JOIN files f USING (file_id) UNION ALL SELECT 'duplicate_run', sub, ses || '/' || run FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, sub, ses, run) AS r FROM dr) WHERE r > 1
UNION ALL SELECT 'invalid_session', sub, 'ses-' || lpad(ses::varchar, 3, '0') FROM iss WHERE i <> '' UNION ALL SELECT CASE WHEN "full" THEN 'full_copy' ELSE 'partial_copy' END, sub, day || ' ' || key FROM cp)"""
register(
    "A23_validate_all", lambda s, d: ds.validate_all(v.files(s, d), _SESSION_LIST(s, d), v.scans(s, d)), [v.SCANS, v.FILES], _FINDINGS + """
    SELECT c.check, count(x.check) AS n, count(DISTINCT x.sub) AS subjects FROM (SELECT unnest(['missing_folder', 'extra_folder', 'session_discrepancy', 'empty_session', 'orphan_sidecar', 'duplicate_run', 'invalid_session', 'full_copy', 'partial_copy']) AS check) c LEFT JOIN x ON x.check = c.check GROUP BY c.check""",
)
register("A23_validation_issues", lambda s, d: ds.validation_issues(v.files(s, d), _SESSION_LIST(s, d), v.scans(s, d)), [v.SCANS, v.FILES], _FINDINGS + " SELECT * FROM x")
register("A23_copies", lambda s, d: ds.copies_of_recordings(_FEW_KINDS(s, d), v.files(s, d).withColumns({"md5": F.expr("if(file_id % 31 = 0, null, cast(length % 2 as string))"), "length": F.lit(1), "ext": F.lit(".edf")})), [v.SCANS, v.FILES],
    _COPIES.format(scans="(SELECT sub, ses, day, (ses % 3)::varchar AS duration FROM scans WHERE ses <= 8)", files="(SELECT sub, ses, '.edf' AS ext, 1 AS length, CASE WHEN file_id % 31 = 0 THEN NULL ELSE (length % 2)::varchar END AS md5 FROM files)", on="true") + " SELECT sub, day, key, n, \"full\" FROM cp")
register("A24_archive_gate", lambda s, d: ds.archive_gate(v.files(s, d), [".edf.gz", ".md5"]), [v.FILES], r"SELECT regexp_extract(name, '^(sub-\d+_ses-\d+_task-[^_]+_run-\d+)', 1) AS base, count(*) AS n, bool_or(ext = '.edf.gz') AND bool_or(ext = '.md5') AS may_go FROM files GROUP BY 1")
register("A26_session_info", lambda s, d: ds.session_info(v.files(s, d)), [v.FILES], "SELECT sub, ses, count(*) FILTER (ext = '.edf') AS edf, count(*) FILTER (ext = '.json') AS json, count(*) FILTER (ext = '.tsv') AS tsv, count(*) FILTER (ext NOT IN ('.edf', '.json', '.tsv')) AS other, count(*) AS total, round(sum(length) / 1048576, 6) AS mb FROM files GROUP BY ALL")
register("K7_audit_log", lambda s, d: ds.audit_log(v.files(s, d), "cleanup"), [v.FILES], "SELECT sub, ses, 'cleanup' AS reason, sum(length)::bigint AS bytes, count(*) AS n, min(mtime) AS first, max(mtime) AS last, string_agg(DISTINCT ext, ';' ORDER BY ext) AS exts FROM files GROUP BY sub, ses")
register(
    "K8_processing_index", lambda s, d: ds.processing_index(v.files(s, d).filter("file_id % 3 <> 0").selectExpr("concat('f', file_id) as path", "md5"), v.files(s, d).filter("file_id % 4 <> 0").selectExpr("concat('f', file_id) as path", "concat('n', md5) as md5"), ["md5"]), [v.FILES],
    "SELECT 'f' || file_id AS path, CASE WHEN file_id % 4 = 0 OR md5 IS NULL THEN CASE WHEN file_id % 3 <> 0 THEN md5 END ELSE 'n' || md5 END AS md5, CASE WHEN file_id % 4 = 0 THEN 'missing' WHEN file_id % 3 = 0 THEN 'processed' ELSE 'updated' END AS status FROM files WHERE file_id % 3 <> 0 OR file_id % 4 <> 0",
)
register(
    "P11_quality_rules", lambda s, d: ds.quality_rules(v.files(s, d).selectExpr("file_id", "length * 700 as size", "cast(256 as bigint) as header_bytes", "cast(if(file_id % 29 = 0, 0, 500) as bigint) as record_bytes", "if(file_id % 23 = 0, -1, cast(floor((length * 700 - 256) / 500) as bigint) + file_id % 4) as records")), [v.FILES],
    """h AS (SELECT file_id, length * 700 AS size, 256::bigint AS header_bytes, CASE WHEN file_id % 29 = 0 THEN 0 ELSE 500 END::bigint AS record_bytes, CASE WHEN file_id % 23 = 0 THEN -1 ELSE floor((length * 700 - 256) / 500)::bigint + file_id % 4 END AS records FROM files),
    i AS (SELECT *, floor((size - header_bytes) / nullif(record_bytes, 0)) AS im FROM h), x AS (SELECT *, concat_ws('; ', CASE WHEN record_bytes <= 0 THEN 'no record size' END, CASE WHEN size <= header_bytes THEN 'no data' END, CASE WHEN records = -1 THEN 'records unknown' END, CASE WHEN records <> -1 AND abs(im - records) > 1 THEN 'size differs' END, CASE WHEN im < 100 THEN 'short' END) AS issues FROM i)
    SELECT file_id, size, header_bytes, record_bytes, records, issues, issues = '' AS ok FROM x""",
)
register("P10_partial_name_match", lambda s, d: ds.partial_name_match(v.files(s, d).select("file_id", "name"), "SES-003_x_pdf"), [v.FILES], "SELECT file_id, name FROM files WHERE lower(name) LIKE '%ses%' OR lower(name) LIKE '%003%' OR lower(name) LIKE '%pdf%'")
register("T4_best_file", lambda s, d: ds.best_file(v.files(s, d), "sub"), [v.FILES], "SELECT sub, max_by(path, (length, mtime, path)) AS path FROM files GROUP BY sub")
register("T5_first_k_issues", lambda s, d: ds.first_k_issues(phi.find(v.texts(s, d), "doc", "text"), "doc", ["label", "match"], 10), [v.TEXTS],
    f"{_FOUND} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY label, match)::int AS place FROM found) WHERE place <= 10")
register(
    "T5_first_failing", lambda s, d: ds.first_failing(v.events_tsv(s, d).selectExpr("rec", "seq div 10 as record", "seq", "text"), "rec", ["high freq", "Opened relay"]).withColumn("sample", F.array_join("sample", "|")), [v.EVENTS_TSV],
    """x AS (SELECT rec, seq // 10 AS record, seq, text, CASE WHEN text NOT IN ('', 'high freq', 'Opened relay') THEN length(text) END AS chars FROM events_tsv), r AS (SELECT rec, record, sum(chars) AS chars, string_agg(text, '|' ORDER BY seq) AS sample FROM x GROUP BY rec, record)
    SELECT rec, count(chars) AS records, coalesce(sum(chars), 0)::bigint AS unknown_chars, min(record) FILTER (chars IS NOT NULL) AS first_failing, min_by(sample, record) FILTER (chars IS NOT NULL) AS sample FROM r GROUP BY rec""",
)
register(
    "J1_tsv_vs_folders", lambda s, d: j.status_outer(v.scans(s, d), v.files(s, d), ["sub", "ses"], "missing", "extra", "ok"), [v.SCANS, v.FILES],
    """a AS (SELECT DISTINCT sub, ses FROM scans), b AS (SELECT DISTINCT sub, ses FROM files) SELECT coalesce(a.sub, b.sub) AS sub, coalesce(a.ses, b.ses) AS ses, CASE WHEN b.sub IS NULL THEN 'missing' WHEN a.sub IS NULL THEN 'extra' ELSE 'ok' END AS status FROM a FULL JOIN b ON a.sub = b.sub AND a.ses = b.ses""",
)
register(
    "J10_reconcile_session", lambda s, d: j.status_outer(v.files(s, d).filter("file_id % 5 <> 0"), v.files(s, d).filter("file_id % 7 <> 0"), ["file_id"], "Missing", "New", "Present"), [v.FILES],
    "SELECT file_id, CASE WHEN file_id % 7 = 0 THEN 'Missing' WHEN file_id % 5 = 0 THEN 'New' ELSE 'Present' END AS status FROM files WHERE file_id % 5 <> 0 OR file_id % 7 <> 0",
)
_HALVES = lambda s, d: (v.files(s, d).filter("file_id % 2 = 0 and length > 0"), v.files(s, d).filter("file_id % 2 = 1 and length > 0"))
register(
    "J2_size_classes", lambda s, d: j.size_classes(*_HALVES(s, d)), [v.FILES],
    """x AS (SELECT CASE file_id % 2 WHEN 0 THEN 'a' ELSE 'b' END AS side, path, length FROM files WHERE length > 0), c AS (SELECT length, count(*) FILTER (side = 'a') AS a, count(*) FILTER (side = 'b') AS b FROM x GROUP BY length)
    SELECT side, path, length, CASE side WHEN 'a' THEN a ELSE b END AS members, CASE side WHEN 'a' THEN b ELSE a END AS partners FROM x JOIN c USING (length) WHERE a > 0 AND b > 0""",
)
register("J2_match_by_size", lambda s, d: j.match_by_size(v.files(s, d).filter("file_id % 2 = 0 and length > 0"), v.files(s, d).filter("file_id % 2 = 1 and length > 0")), [v.FILES], "SELECT a.path AS path_a, b.path AS path_b, a.length FROM files a JOIN files b ON a.length = b.length WHERE a.file_id % 2 = 0 AND b.file_id % 2 = 1 AND a.length > 0")
register(
    "J3_compare_steps", lambda s, d: j.compare_steps(v.files(s, d).filter("file_id % 3 = 0 and md5 is not null").selectExpr("path", "length", "md5 as start", "file_id % 2 as milli"), v.files(s, d).filter("file_id % 3 <> 0 and md5 is not null").selectExpr("path", "length", "md5 as start", "file_id % 2 as milli"), v.files(s, d).filter("file_id % 4 = 1").select("path")), [v.FILES],
    """SELECT a.path, b.path AS raw_path, CASE WHEN b.path IN (SELECT path FROM files WHERE file_id % 4 = 1) THEN 'compliant' ELSE 'missing marker' END AS state FROM files a JOIN files b ON a.length = b.length AND a.md5 = b.md5 AND a.file_id % 2 = b.file_id % 2 WHERE a.file_id % 3 = 0 AND b.file_id % 3 <> 0""",
)
register(
    "J6_merge_participants", lambda s, d: j.merge_participants(v.demographics(s, d).selectExpr("if(idx % 11 = 0, concat('z', idx), id) as id").distinct(), v.demographics(s, d)), [v.DEMOGRAPHICS],
    """o AS (SELECT * FROM demographics QUALIFY row_number() OVER (PARTITION BY id ORDER BY idx) = 1) SELECT id, age, sex, coalesce(nullif(grp, ''), 'patient') AS grp FROM (SELECT DISTINCT CASE WHEN idx % 11 = 0 THEN 'z' || idx ELSE id END AS id FROM demographics) LEFT JOIN o USING (id)""",
)
register(
    "J7_archive_metadata", lambda s, d: j.archive_metadata(v.files(s, d).selectExpr("if(file_id % 6 = 0, concat('other/', name), if(file_id % 6 = 1, 'none', path)) as path"), v.files(s, d).selectExpr("path", "cast(mtime as string) as acq_time", "file_id as idx")), [v.FILES],
    """a AS (SELECT DISTINCT CASE file_id % 6 WHEN 0 THEN 'other/' || name WHEN 1 THEN 'none' ELSE path END AS path FROM files), m AS (SELECT a.path, f.mtime, row_number() OVER (PARTITION BY a.path ORDER BY f.file_id NULLS LAST) AS k FROM a LEFT JOIN files f ON a.path = f.path OR regexp_extract(a.path, '([^/]*)$', 1) = f.name)
    SELECT path, mtime::varchar AS acq_time, CASE WHEN mtime IS NULL THEN 'manual_required' ELSE 'found' END AS state FROM m WHERE k = 1""",
)
register(
    "J8_session_plan", lambda s, d: j.session_plan(v.files(s, d).withColumn("ses", F.expr("file_id % 90")), v.files(s, d).filter("ses > 2")), [v.FILES],
    """x AS (SELECT sub, file_id % 90 AS ses, count(*) FILTER (length > 0) AS n FROM files GROUP BY ALL), y AS (SELECT DISTINCT sub, ses, true AS there FROM files WHERE ses > 2)
    SELECT sub, ses, CASE WHEN there THEN 'MERGE' ELSE 'COPY' END AS action, n = 0 AS empty, there IS NULL AND n > 0 AS selected FROM x LEFT JOIN y USING (sub, ses)""",
)
# a session's folder with its whole number: names hold three digits, so sessions 100 and 1000 of a subject share theirs
_whole = lambda scans: scans.withColumn("filename", F.concat_ws("/", "sub", "ses", "filename"))
register(
    "J9_set_compare", lambda s, d: j.set_compare(_whole(v.scans(s, d)).filter("ses % 7 <> 0"), _whole(v.scans(s, d)).filter("ses % 5 <> 0").withColumn("duration", F.concat(F.lit(" "), "duration")), ["filename", "acq_time", "duration"]), [v.SCANS],
    "SELECT count(*) FILTER (ses % 7 <> 0 AND ses % 5 = 0) AS only_left, count(*) FILTER (ses % 7 = 0 AND ses % 5 <> 0) AS only_right, count(*) FILTER ((ses % 7 = 0) <> (ses % 5 = 0)) = 0 AS equal FROM scans",
)
# pieces are cut in one pass over a text, which doesn't go with each of them
_CUT = lambda x: f"posexplode(if(length({x}) > 0, regexp_extract_all({x}, '(?s)(.{{1,64}})', 1), array({x}))) as (chunk, piece)"
_CHUNKS = lambda s, d, x: v.files(s, d).selectExpr("file_id as pair", _CUT(x)).selectExpr("pair", "chunk", "md5(cast(piece as binary)) as md5")
register(
    "J11_chunk_diff", lambda s, d: j.chunk_diff(_CHUNKS(s, d, "text"), _CHUNKS(s, d, "replace(text, 'x', 'y')")), [v.FILES],
    """c AS (SELECT file_id AS pair, text, unnest(range(0, greatest(ceil(length(text) / 64), 1)::bigint)) AS chunk FROM files), m AS (SELECT pair, chunk, CASE WHEN substr(text, chunk * 64 + 1, 64) = replace(substr(text, chunk * 64 + 1, 64), 'x', 'y') THEN '=' ELSE 'X' END AS mark FROM c)
    SELECT pair, chunk // 70 AS line, string_agg(mark, '' ORDER BY chunk) AS map FROM m GROUP BY ALL""",
)
register(
    "J12_signal_equality", lambda s, d: j.signal_equality(v.samples(s, d), v.samples(s, d).withColumn("v", F.expr("if(idx % 9 = 0, v + idx / 7, v)"))), [v.SAMPLES],
    "SELECT rec, channel, count(*) AS n, count(*) FILTER (d > 1e-10) AS differ, round(avg(d), 6) AS mean, round(max(d), 6) AS largest, count(*) FILTER (d <> 0) = 0 AS exact, round(100 * count(*) FILTER (d > 1e-10) / count(*), 6) AS percent FROM (SELECT *, abs(v - CASE WHEN idx % 9 = 0 THEN v + idx / 7 ELSE v END) AS d FROM samples) GROUP BY rec, channel",
)
_LAB = "c_nationkey as rec", "c_custkey as idx", "if(c_custkey % 19 = 0, 'EDF Annotations', concat('CH', c_custkey % 6)) as label"
register(
    "J13_label_compare", lambda s, d: j.label_compare(v.table(s, d, "customer").selectExpr(*_LAB), v.table(s, d, "customer").selectExpr("c_nationkey as rec", "c_custkey as idx", "if(c_custkey % 19 = 0, 'EDF Annotations', concat('CH', c_custkey % 5)) as label")), [],
    "SELECT c_nationkey AS rec, count(*) FILTER (c_custkey % 6 = c_custkey % 5) AS same, count(*) FILTER (c_custkey % 6 <> c_custkey % 5) AS different FROM customer WHERE c_custkey % 19 <> 0 GROUP BY 1",
)
register(
    "J16_valid_pulses", lambda s, d: j.valid_pulses(v.files(s, d).selectExpr("sub as pair", "file_id as sample"), v.files(s, d).filter("sub % 2 = 0 and file_id % 3 = 0").selectExpr("sub as pair", "file_id as sample")), [v.FILES],
    "SELECT sub AS pair, file_id AS sample FROM files WHERE (sub % 2 = 0 AND file_id % 3 = 0) OR sub NOT IN (SELECT sub FROM files WHERE sub % 2 = 0 AND file_id % 3 = 0)",
)
register(
    "J17_cleanup_plan", lambda s, d: j.cleanup_plan(v.files(s, d).filter("file_id % 3 = 0").selectExpr("regexp_extract(name, '^([^.]*)', 1) as stem", "concat('to/', sub) as target", "if(file_id % 2 = 0, 'unique match', 'many') as status"), v.files(s, d)), [v.FILES],
    """u AS (SELECT DISTINCT regexp_extract(name, '^([^.]*)', 1) AS stem, 'to/' || sub AS target FROM files WHERE file_id % 6 = 0), k AS (SELECT DISTINCT regexp_extract(name, '^([^.]*)', 1) AS stem, true AS marked FROM files WHERE ext = '.md5')
    SELECT file_id, target, CASE WHEN ext = '.edf' AND marked THEN 'delete' WHEN ext = '.edf' THEN 'keep' ELSE 'move' END AS action FROM (SELECT *, regexp_extract(name, '^([^.]*)', 1) AS stem FROM files WHERE ext <> '.md5') JOIN u USING (stem) LEFT JOIN k USING (stem)""",
)
register("A14_signal_stats", lambda s, d: sg.signal_stats(v.samples(s, d)), [v.SAMPLES], "SELECT rec, channel, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS low, max(v) AS high FROM samples GROUP BY rec, channel")
register("W7_moving_average", lambda s, d: sg.moving_average(v.samples(s, d), 10), [v.SAMPLES], "SELECT rec, channel, idx, round(avg(v) OVER (PARTITION BY rec, channel ORDER BY idx ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING), 6) AS smooth FROM samples")
_EV = lambda s, d: v.table(s, d, "orders").selectExpr("o_custkey % 40 as rec", "o_orderkey").join(v.samples(s, d).groupBy("rec").agg(F.max("idx").alias("last")), "rec").selectExpr("rec", "o_orderkey % (last + 1) as event").distinct()
_PULSES = "pe AS MATERIALIZED (SELECT DISTINCT rec, o_orderkey % (last + 1) AS event FROM orders JOIN (SELECT rec, max(idx) AS last FROM samples GROUP BY rec) ON rec = o_custkey % 40)"
_EPOCHS = _PULSES + ", ls AS (SELECT rec, channel, max(idx) AS last FROM samples GROUP BY ALL), epochs AS (SELECT s.rec, s.channel, event, s.idx - event AS \"offset\", v FROM samples s JOIN pe USING (rec) JOIN ls ON ls.rec = s.rec AND ls.channel = s.channel WHERE s.idx >= event - 5 AND s.idx < event + 10 AND event >= 5 AND event + 9 <= last)"
register("J14_epoch_events", lambda s, d: sg.epoch_events(v.samples(s, d), _EV(s, d), 5, 10), [v.SAMPLES], _EPOCHS + " SELECT * FROM epochs")
register("N13_average_epochs", lambda s, d: sg.average_epochs(sg.epoch_events(v.samples(s, d), _EV(s, d), 5, 10)), [v.SAMPLES], _EPOCHS + ' SELECT rec, channel, "offset", count(*) AS n, round(avg(v), 6) AS mean FROM epochs GROUP BY ALL')
register(
    "N9_baseline_zscore", lambda s, d: sg.zscore_windows(sg.epoch_windows(v.samples(s, d), _EV(s, d), 5, 10), 5), [v.SAMPLES],
    _EPOCHS + ', b AS (SELECT rec, channel, event, avg(v) AS m, stddev_pop(v) AS sd FROM epochs WHERE "offset" < 0 GROUP BY ALL) SELECT rec, channel, event, "offset", round((v - m) / nullif(sd, 0), 6) AS z FROM epochs LEFT JOIN b USING (rec, channel, event)',
)
register(
    "W8_orientation", lambda s, d: fl.orientation(v.samples(s, d).withColumn("v", F.expr("v - 50000")), _EV(s, d), 4, 10).withColumns({"pre": F.round("pre", 6), "post": F.round("post", 6)}), [v.SAMPLES],
    _PULSES + """, x AS (SELECT rec, channel, idx, v - 50000 AS v0, lead(v - 50000, 4) OVER o AS v1, lag(v - 50000) OVER o AS b, first_value(v - 50000) OVER (o ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS f, last_value(v - 50000) OVER (o ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l,
    max(idx) OVER (PARTITION BY rec, channel) AS last FROM samples WINDOW o AS (PARTITION BY rec, channel ORDER BY idx))
    SELECT x.rec, channel, event, CASE WHEN event = 0 OR v1 IS NULL THEN NULL WHEN v0 + v1 < 0 THEN -1 ELSE 1 END AS orientation, CASE WHEN event < 2 THEN 0 ELSE round((b - f) / (event - 1 - greatest(event - 10, 0)), 6) END AS pre,
    CASE WHEN event = 0 OR event = last THEN 0 ELSE round((l - v0) / (least(event + 9, last) - event), 6) END AS post FROM pe JOIN x ON x.rec = pe.rec AND x.idx = event""",
)
_TURNED = lambda s, d: v.samples(s, d).withColumn("v", F.expr("v - 50000"))
_ORIENTED = _PULSES + """, o AS (SELECT x.rec, channel, event, last, CASE WHEN event = 0 OR v1 IS NULL THEN NULL WHEN v0 + v1 < 0 THEN -1 ELSE 1 END AS orientation, CASE WHEN event < 2 THEN 0 ELSE round((b - f) / (event - 1 - greatest(event - 10, 0)), 6) END AS pre, CASE WHEN event = 0 OR event = last THEN 0 ELSE round((l - v0) / (least(event + 9, last) - event), 6) END AS post
FROM pe JOIN (SELECT rec, channel, idx, v - 50000 AS v0, lead(v - 50000, 4) OVER o AS v1, lag(v - 50000) OVER o AS b, first_value(v - 50000) OVER (o ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS f, last_value(v - 50000) OVER (o ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l, max(idx) OVER (PARTITION BY rec, channel) AS last FROM samples WINDOW o AS (PARTITION BY rec, channel ORDER BY idx)) x ON x.rec = pe.rec AND x.idx = event),
fd AS (SELECT e.rec, e.channel, e.event, CASE WHEN e.event >= 5 AND e.event + 9 <= e.last THEN coalesce(s.orientation <> e.orientation, false) END AS flip, CASE WHEN NOT (e.event >= 5 AND e.event + 9 <= e.last) THEN 'out of bounds' WHEN s.orientation IS NULL OR e.orientation IS NULL THEN 'ambiguous' WHEN s.orientation <> e.orientation THEN 'opposite' ELSE 'same' END AS reason,
s.orientation AS stim_orientation, e.orientation AS evoked_orientation, s.pre AS stim_pre, s.post AS stim_post, e.pre AS evoked_pre, e.post AS evoked_post FROM o e LEFT JOIN o s ON s.rec = e.rec AND s.event = e.event AND s.channel = 1 WHERE e.channel <> 1)"""
_DECIDED = lambda s, d: sg.flip_decisions(_TURNED(s, d), _EV(s, d), 1, 5, 10, 4, 10)
register("N13_flip_decisions", lambda s, d: _DECIDED(s, d).withColumns({f"{a}_{b}": F.round(f"{a}_{b}", 6) for a in ("stim", "evoked") for b in ("pre", "post")}), [v.SAMPLES], _ORIENTED + " SELECT * FROM fd")
register(
    "N13_average_flipped", lambda s, d: sg.average_flips(sg.flips(_TURNED(s, d), _EV(s, d), 1, 5, 10, 4, 10), 5), [v.SAMPLES],
    _ORIENTED + ', ' + _EPOCHS.removeprefix(_PULSES + ", ") + """ SELECT rec, channel, "offset", count(v) AS n, count(*) FILTER (flip) AS flipped, round(avg(CASE WHEN flip THEN 50000 - v ELSE v - 50000 END), 6) AS mean FROM epochs JOIN fd USING (rec, channel, event) WHERE flip IS NOT NULL GROUP BY ALL""",
)
register(
    # in units of pi: no residual of decimal samples then lies on a tie, where the two engines round apart
    "N10_detrend_linear", lambda s, d: sg.detrend_linear(v.samples(s, d)).select("rec", "channel", "idx", F.round(F.col("rest") / F.pi(), 4).alias("rest_pi")), [v.SAMPLES],
    "l AS (SELECT rec, channel, regr_slope(v, idx) AS a, regr_intercept(v, idx) AS b FROM samples GROUP BY ALL) SELECT rec, channel, idx, round((v - (a * idx + b)) / pi(), 4) AS rest_pi FROM samples JOIN l USING (rec, channel)",
)
register(
    "N10_detrend_cubic", lambda s, d: fl.detrend_cubic(v.samples(s, d)).select("rec", "channel", "idx", F.round(F.col("rest") / F.pi(), 3).alias("rest_pi")), [v.SAMPLES],
    """m AS (SELECT rec, channel, (max(idx) + 1)::double AS n FROM samples GROUP BY ALL), t AS (SELECT *, idx - (n - 1) / 2 AS t FROM samples JOIN m USING (rec, channel)),
    p AS (SELECT *, t * t - (n * n - 1) / 12 AS q, t * t * t - t * (3 * n * n - 7) / 20 AS r FROM t),
    c AS (SELECT rec, channel, avg(v) AS c0, sum(v * t) / nullif(sum(t * t), 0) AS c1, sum(v * q) / nullif(sum(q * q), 0) AS c2, CASE WHEN count(*) > 3 THEN sum(v * r) / nullif(sum(r * r), 0) END AS c3 FROM p GROUP BY ALL)
    SELECT rec, channel, idx, round((v - (c0 + c1 * t + c2 * q + c3 * r) + (c3 - greatest(-1e-3, least(1e-3, c3))) * idx::double * idx * idx) / pi(), 3) AS rest_pi FROM p JOIN c USING (rec, channel)""",
)
register(
    "N10_median_filter", lambda s, d: fl.median_filter(v.samples(s, d), 5), [v.SAMPLES],
    "w AS (SELECT rec, channel, idx, list(v) OVER (PARTITION BY rec, channel ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS x FROM samples) SELECT rec, channel, idx, list_sort(list_concat(x, [0.0::double, 0.0, 0.0, 0.0][:5 - len(x)]))[3] AS median FROM w",
)
_PEAKS = """x AS (SELECT rec, channel, idx, sign(lead(v) OVER w - v) AS nx, sign(v - lag(v) OVER w) AS bf, lag(v) OVER w AS a, lead(v) OVER w AS b, v, min(v) OVER (w ROWS UNBOUNDED PRECEDING) AS low,
    max(v) OVER c - min(v) OVER c AS span, max(idx) OVER c AS last FROM {} WINDOW w AS (PARTITION BY rec, channel ORDER BY idx), c AS (PARTITION BY rec, channel))"""
register(
    "N11_find_peaks", lambda s, d: fl.find_peaks(v.samples(s, d), endpoints=False).select("rec", "channel", "idx", "v"), [v.SAMPLES],
    _PEAKS.format("samples") + " SELECT rec, channel, idx, v FROM x WHERE nx < bf AND v > span * 0.25 AND v - low > span * 0.25",
)
register(
    "N11_troughs_by_width", lambda s, d: fl.find_peaks(v.samples(s, d), sel=9000.0, thresh=-60000.0, extrema=-1, least=2, most=4).withColumn("place", F.round("place", 5)), [v.SAMPLES],
    "neg AS (SELECT rec, channel, idx, -v AS v FROM samples), " + _PEAKS.format("neg") + """, y AS (SELECT *, coalesce(max(CASE WHEN nx <= 0 THEN idx + 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rise,
    coalesce(min(CASE WHEN nx >= 0 THEN idx END) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last) AS fall FROM x WINDOW w AS (PARTITION BY rec, channel ORDER BY idx))
    SELECT rec, channel, idx, round(coalesce(idx + 0.5::double * (a - b) / (a - 2 * v + b), idx::double), 5) AS place, -v AS v FROM y
    WHERE (nx < bf OR bf IS NULL AND nx < 0 OR nx IS NULL AND bf > 0) AND v > -60000 AND v - low > 9000 AND fall - rise BETWEEN 2 AND 4""",
)

from tidemark.functions import redaction as rd  # noqa: E402
from tidemark.functions import tables as tb  # noqa: E402
from tidemark.functions import tagging as tg  # noqa: E402
from tidemark.sources import edf, edf_files, tsv  # noqa: E402
from tidemark.sources.shared import new_folder  # noqa: E402
from tidemark.streaming import live  # noqa: E402


def _back(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write as TSV and read again."""
    path = new_folder(spark, name)
    tsv.write_tsv(df, path)
    return tsv.read_tsv(spark, path)


register(
    "S1_read_scans_tsv", lambda s, d: tsv.typed_scans(_back(s, v.scans(s, d).selectExpr("filename", "if(ses % 9 = 0, replace(acq_time, 'T', ' '), acq_time) as acq_time", "if(ses % 10 = 0, 'n/a', duration) as duration"), "scans")), [v.SCANS],
    "SELECT filename, CASE WHEN ses % 9 = 0 THEN replace(acq_time, 'T', ' ') ELSE acq_time END AS acq_time, CASE WHEN ses % 10 = 0 THEN 'n/a' ELSE duration END AS duration, epoch(acq_time::timestamp)::bigint AS acq_s, CASE WHEN ses % 10 = 0 THEN NULL ELSE hours END AS duration_h FROM scans",
)


def _written_texts(spark: SparkSession, sf_dir: str) -> str:
    root = new_folder(spark, "files")
    v.files(spark, sf_dir).selectExpr("sub", "replace(text, '\\n', ' ') as line").repartition("sub").write.partitionBy("sub").text(root)
    return root


register("S2_list_files", lambda s, d: tsv.list_files(s, _written_texts(s, d), "txt", ["part-*"], ["*.crc"]).selectExpr("regexp_extract(path, '/sub=(\\\\d+)/', 1) as sub", "length"), [v.FILES], "SELECT sub::varchar AS sub, sum(strlen(text) + 1)::bigint AS length FROM files GROUP BY sub")
_SIGNAL = {"unit": "uV", "phys_min": "-500", "phys_max": "500", "dig_min": "-2000", "dig_max": "2000", "prefilter": "HP:0.1Hz LP:70Hz", "spr": "50"}


def _recordings(spark: SparkSession, sf_dir: str, start: str = "0", **header) -> str:
    """A folder with a file for each recording: channels 1 to 7 as signals A1 to A7 in records of 50 samples, its annotations by fours. start: the onset of the first list."""
    cells = v.samples(spark, sf_dir).selectExpr("rec", "channel - 1 as channel", "cast(floor(idx / 50) as bigint) as record", "idx % 50 as k", "(floor(v) % 4001 - 2000) * 0.25D as v")
    values = cells.groupBy("rec", "record", "channel").agg(F.expr("transform(array_sort(collect_list(struct(k, v))), x -> x.v) as values"))
    notes = v.events_tsv(spark, sf_dir).selectExpr("rec", "cast(floor((seq - 1) / 4) as bigint) as record", "seq", "concat('+', format_string('%.6f', onset), '\u0014', text, '\u0014\u0000') as t")
    lists = notes.groupBy("rec", "record").agg(F.expr("array_join(transform(array_sort(collect_list(struct(seq, t))), x -> x.t), '') as t"))
    # idx and seq count from 0 and 1 without gaps, so that numbers of rows tell the last record without sorting them again
    samples = v.table(spark, sf_dir, "lineitem").groupBy(F.expr("l_suppkey % 40").alias("rec"), "l_linenumber").agg(F.floor((F.count("*") - 1) / 50).alias("record"))
    events = v.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("rec")).agg(F.floor((F.count("*") - 1) / 4).alias("record"))
    sizes = samples.select("rec", "record").union(events).groupBy("rec").agg((F.max("record") + 1).alias("n_records"))
    every = sizes.selectExpr("rec", "explode(sequence(0L, n_records - 1)) as record").join(lists, ["rec", "record"], "left")
    clock = f"concat('+', record + {start}, '\u0014\u0014\u0000', coalesce(t, ''))"
    rows = values.selectExpr("rec", "record", "channel", "values", "cast(null as binary) as tal").unionByName(every.selectExpr("rec", "record", "7L as channel", "cast(null as array<double>) as values", f"encode({clock}, 'UTF-8') as tal"))
    folder = new_folder(spark, "recordings")
    edf_files.write(rows.join(sizes, "rec"), folder, [{"label": f"A{i}", **_SIGNAL} for i in range(1, 8)], annotation_bytes=512, **header).count()
    return folder


_rec = lambda: F.regexp_extract("path", r"([0-9]+)\.edf$", 1).cast("long").alias("rec")
_EDF_SQL = """es AS (SELECT rec, channel - 1 AS channel, idx // 50 AS record, idx % 50 AS k, (floor(v)::bigint % 4001 - 2000) * 0.25::double AS v FROM samples),
en AS (SELECT rec, max(record) + 1 AS n FROM (SELECT rec, record FROM es UNION ALL SELECT rec, (seq - 1) // 4 FROM events_tsv) GROUP BY rec)"""
register(
    "S4_edf_header", lambda s, d: edf_files.read(s, _recordings(s, d, count=False), "headers").select(_rec(), "patient", "day", "clock", "n_records", "record_s", F.size("signals").alias("n_signals"), F.expr("signals[6].label as label"), F.expr("signals[6].prefilter as prefilter"), F.expr("cast(signals[0].spr as int) as spr"), "reason"),
    [v.SAMPLES, v.EVENTS_TSV],
    f"{_EDF_SQL} SELECT rec, 'X X X X' AS patient, '02.01.24' AS day, '03.04.05' AS clock, n AS n_records, 1.0::double AS record_s, 8 AS n_signals, 'A7' AS label, 'HP:0.1Hz LP:70Hz' AS prefilter, 50 AS spr, NULL::varchar AS reason FROM en",
)
register(
    "S5_edf_samples", lambda s, d: edf_files.read(s, _recordings(s, d)).select(_rec(), "channel", "record", F.posexplode("values").alias("k", "v")).filter("v <> 0"), [v.SAMPLES, v.EVENTS_TSV],
    f"{_EDF_SQL} SELECT rec, channel::int AS channel, record, k::int AS k, v FROM es WHERE v <> 0",
)
register(
    "N5_clip_recording", lambda s, d: edf_files.read(s, _recordings(s, d)).filter("channel in (1, 4) and record >= 1 and record < 3").select(_rec(), "channel", "record", F.size("values").alias("n"), F.expr("round(aggregate(values, 0D, (a, x) -> a + x), 4) as total")), [v.SAMPLES, v.EVENTS_TSV],
    f"{_EDF_SQL} SELECT rec, c::int AS channel, r AS record, 50 AS n, round(coalesce(sum(v), 0), 4) AS total FROM en, (SELECT unnest([1, 4]) AS c), (SELECT unnest([1, 2]) AS r) LEFT JOIN es ON es.rec = en.rec AND es.channel = c AND es.record = r WHERE r < n GROUP BY ALL".replace("SELECT rec, c::int", "SELECT en.rec, c::int"),
)
_FOUND = lambda s, d, **k: edf.events_of(edf_files.read(s, _recordings(s, d, **k), "annotations"))
_FOUND_SQL = "SELECT rec, (min(seq) - 1) // 4 AS record, ((min(seq) - 1) % 4 + 1)::int AS place, round(onset - {0}, 6) AS onset, text FROM events_tsv WHERE text <> '' GROUP BY rec, round(onset - {0}, 6), text"
register("S6_edf_annotations", lambda s, d: _FOUND(s, d).select(_rec(), "record", "place", "onset", "text"), [v.EVENTS_TSV], _FOUND_SQL.format("0"))
register("W10_tal_offset", lambda s, d: _FOUND(s, d, start="1.5").select(_rec(), "record", "place", "onset", "text"), [v.EVENTS_TSV], _FOUND_SQL.format("1.5"))
register(
    "F13_blank_tal", lambda s, d: edf.encode_tal(v.events_tsv(s, d)).select("rec", F.length("content").alias("size"), edf.blank_tal(F.col("content")).alias("b")).selectExpr("rec", "size", "length(b) as blank_size", "regexp_count(decode(b, 'ISO-8859-1'), '[A-Za-z]') as letters"), [v.EVENTS_TSV],
    "SELECT rec, (5 + sum(length('+' || printf('%.6f', onset)) + length(text) + 3))::int AS size, size AS blank_size, 0 AS letters FROM events_tsv GROUP BY rec",
)
_NOTES = "encode(concat('(', array_join(transform(array_sort(collect_list(struct(seq, concat('(.\"CreationTime\", ', cast(45292 + seq as string), '.5)(.\"Stamp\", ', cast(seq * 10 as string), ')(.\"Text\", \"', text, '\")') as t))), x -> x.t), ''), ')'), 'ISO-8859-1') as content"
_ENT = lambda s, d: v.events_tsv(s, d).groupBy("rec").agg(F.expr(_NOTES))
register("S7_ent_events", lambda s, d: edf.ent_events(_ENT(s, d), "rec"), [v.EVENTS_TSV], "SELECT rec, (45292.5 + seq)::double AS serial, seq * 10 AS stamp, text FROM events_tsv")
register("S8_ent_key_values", lambda s, d: edf.key_values(_ENT(s, d), "rec").groupBy("rec").agg(F.count("*").alias("n"), F.count_distinct("path").alias("paths")), [v.EVENTS_TSV], "SELECT rec::varchar AS rec, count(*) * 3 AS n, count(*) * 3 AS paths FROM events_tsv GROUP BY rec")
register(
    "S9_quick_metadata", lambda s, d: edf.quick_metadata(v.demographics(s, d).selectExpr("id", "idx", "encode(concat(repeat('x', 361), '(.\"', if(idx % 3 = 0, 'Study', 'StudyName'), '\", \"st', idx, '\")(.\"EegNo\", \"', id, '\")', if(idx % 4 = 0, '', '(.\"Machine\", \"M1\")'), '(.\"CreationTime\", 45292.25)'), 'ISO-8859-1') as content"), "idx"), [v.DEMOGRAPHICS],
    "SELECT idx, 'st' || idx AS study, id AS eeg_no, CASE WHEN idx % 4 = 0 THEN NULL ELSE 'M1' END AS machine, '45292.25' AS start FROM demographics",
)
register(
    "S10_log_mappings", lambda s, d: edf.log_mappings(v.events_tsv(s, d).selectExpr("rec as log", "seq as n", "case seq % 4 when 0 then concat('anonymization of: x', seq, '.EDF') when 1 then concat('Output will be saved to: y/sub-', seq, '_a.edf') when 2 then if(seq % 3 = 0, concat('anonymization of: z', seq, '.EDF'), 'noise') else if(seq % 5 = 0, concat('Output will be saved to: y/sub-', seq, '_b.edf'), '') end as line")), [v.EVENTS_TSV],
    """l AS (SELECT rec AS log, seq AS n, CASE WHEN seq % 4 = 0 THEN 'x' || seq || '.EDF' WHEN seq % 4 = 2 AND seq % 3 = 0 THEN 'z' || seq || '.EDF' END AS source, CASE WHEN seq % 4 = 1 THEN 'sub-' || seq || '_a.edf' WHEN seq % 4 = 3 AND seq % 5 = 0 THEN 'sub-' || seq || '_b.edf' END AS target FROM events_tsv),
    k AS (SELECT *, lag(source) OVER (PARTITION BY log ORDER BY n) AS before FROM l WHERE source IS NOT NULL OR target IS NOT NULL) SELECT log, before AS source, target FROM k WHERE target IS NOT NULL AND before IS NOT NULL""",
)
_HASHES = lambda s, d, x: edf.chunk_hashes(v.files(s, d).selectExpr("file_id", f"cast({x} as binary) as content"), "file_id", head=64, size=1000)
_CHUNKED = lambda x: f"""SELECT file_id, chunk, sha256(CASE WHEN chunk < 0 THEN array_slice(b, 1, 64) ELSE array_slice(b, chunk * 1000 + 65, chunk * 1000 + 1064) END) AS sha256
    FROM (SELECT *, unnest(range(-1, greatest(ceil((octet_length(b) - 64) / 1000), 0)::bigint))::int AS chunk FROM (SELECT file_id, encode({x}) AS b FROM files))"""  # noqa: E731
register("A20_chunk_hashes", lambda s, d: _HASHES(s, d, "text"), [v.FILES], _CHUNKED("text"))
register(
    "A20_verify_chunks", lambda s, d: edf.verify_chunks(_HASHES(s, d, "text"), _HASHES(s, d, "if(file_id % 5 = 0, concat('##', substring(text, 3)), if(file_id % 5 = 1, left(text, 10), text))"), "file_id"), [v.FILES],
    f"""k AS ({_CHUNKED("text")}), o AS ({_CHUNKED("CASE file_id % 5 WHEN 0 THEN '##' || substr(text, 3) WHEN 1 THEN left(text, 10) ELSE text END")})
    SELECT file_id, chunk, CASE WHEN o.sha256 IS NULL THEN 'missing' WHEN chunk < 0 THEN 'header mismatch' ELSE 'chunk mismatch' END AS state FROM k LEFT JOIN o USING (file_id, chunk) WHERE o.sha256 IS DISTINCT FROM k.sha256""",
)
_BOTH = lambda s, folder: (edf_files.read(s, folder, "headers"), edf_files.read(s, folder, "annotations"))
register(
    "F14_verify_anonymized", lambda s, d: edf.verify_anonymized(*_BOTH(s, _recordings(s, d, patient="Jane Doe")), ["Opened relay", "3"]).select(_rec(), *[F.col("findings").contains(t).alias(n) for t, n in (("patient", "patient"), ("recording", "recording"), ("text: high freq", "high"), ("text: Opened relay", "allowed"), ("text: é", "accent"))]), [v.SAMPLES, v.EVENTS_TSV],
    f"{_EDF_SQL} SELECT rec, true AS patient, false AS recording, coalesce(bool_or(text = 'high freq'), false) AS high, false AS allowed, coalesce(bool_or(text = 'é'), false) AS accent FROM en LEFT JOIN events_tsv USING (rec) GROUP BY rec",
)
_TRIED = lambda s, folder: edf_files.read(s, folder, "headers").select("path", _rec()).filter("rec % 5 <> 4").selectExpr("path", "cast(rec % 3 + 1 as int) as tries", "if(rec % 7 = 6, 'timeout', null) as error")
_SUMMED = lambda s, folder: edf.recording_summary(*_BOTH(s, folder), _TRIED(s, folder))
_SUMMED_SQL = f"""{_EDF_SQL}, t AS (SELECT rec, count(*) FILTER (text <> '') AS n_annotations FROM events_tsv GROUP BY rec),
r AS (SELECT rec, CASE WHEN rec % 5 = 4 THEN 'skipped' WHEN rec % 7 = 6 THEN 'failed' ELSE 'done' END AS status, CASE WHEN rec % 5 = 4 THEN 0 ELSE rec % 3 + 1 END::int AS tries, n::double AS seconds, 8 AS n_signals, 'A1,A2,A3,A4,A5,A6,A7,EDF Annotations' AS labels, coalesce(n_annotations, 0) AS n_annotations,
true AS patient_blank, true AS recording_blank, false AS day_neutral, CASE WHEN rec % 5 <> 4 AND rec % 7 = 6 THEN 'timeout' END AS note FROM en LEFT JOIN t USING (rec))"""
register("A27_recording_summary", lambda s, d: _SUMMED(s, _recordings(s, d)).select(_rec(), "status", "tries", "seconds", "n_signals", "labels", "n_annotations", "patient_blank", "recording_blank", "day_neutral", "note"), [v.SAMPLES, v.EVENTS_TSV], f"{_SUMMED_SQL} SELECT * FROM r")
register("A27_status_totals", lambda s, d: edf.status_totals(_SUMMED(s, _recordings(s, d))), [v.SAMPLES, v.EVENTS_TSV], f"{_SUMMED_SQL} SELECT status, count(*) AS files, sum(tries)::bigint AS tries, sum(seconds) AS seconds FROM r GROUP BY status")


def _archives(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the texts of each session's files: as one zip, as one gzip and plain, by turns."""
    import gzip
    import io
    import zipfile

    folder = new_folder(spark, "archives")

    def packed(frames):
        for f in frames:
            for sub, ses, texts in zip(f["sub"], f["ses"], f["texts"], strict=True):
                name, raw = f"sub-{sub}_ses-{ses}", "".join(texts).encode()
                system, root = edf_files.at(folder)
                system.create_dir(root, recursive=True)
                if ses % 3 == 0:
                    held = io.BytesIO()
                    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                        for i, t in enumerate(texts):
                            z.writestr(f"{i}.txt", t)
                    raw, name = held.getvalue(), f"{name}.zip"
                elif ses % 3 == 1:
                    raw, name = gzip.compress(raw), f"{name}.edf.gz"
                with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(raw)
            yield f[["sub"]]

    v.files(spark, sf_dir).groupBy("sub", "ses").agg(F.collect_list("text").alias("texts")).mapInPandas(packed, "sub long").count()
    return folder


register(
    "S11_archive_uncompressed_size", lambda s, d: edf_files.read(s, _archives(s, d), "archives").select(F.regexp_extract("path", r"sub-(\d+)_", 1).cast("long").alias("sub"), F.regexp_extract("path", r"ses-(\d+)", 1).cast("long").alias("ses"), "kind", "unpacked", "reason"), [v.FILES],
    "SELECT sub, ses, ['zip', 'gzip', 'file'][(ses % 3 + 1)::int] AS kind, sum(strlen(text))::bigint AS unpacked, NULL::varchar AS reason FROM files GROUP BY sub, ses",
)
_PART = "if(idx % 5 = 0, null, cast(idx % 100 as int)) as age", "if(idx % 3 = 0, null, 'm') as sex", "grp as group"
register(
    "K1_write_participants", lambda s, d: _back(s, tsv.participants(v.demographics(s, d).selectExpr("id as participant_id", *_PART), v.demographics(s, d).filter("idx % 20 = 0").selectExpr("id as participant_id", "'1' as age", "'f' as sex", "'old' as group")), "participants"), [v.DEMOGRAPHICS],
    """n AS (SELECT id AS participant_id, CASE WHEN idx % 5 = 0 THEN 'n/a' WHEN idx % 100 >= 89 THEN '89+' ELSE (idx % 100)::varchar END AS age, CASE WHEN idx % 3 = 0 THEN 'X' ELSE 'm' END AS sex, grp AS "group" FROM demographics)
    SELECT id AS participant_id, '1' AS age, 'f' AS sex, 'old' AS "group" FROM demographics WHERE idx % 20 = 0 UNION ALL (SELECT * FROM n WHERE participant_id NOT IN (SELECT id FROM demographics WHERE idx % 20 = 0) QUALIFY row_number() OVER (PARTITION BY participant_id ORDER BY age, sex, "group") = 1)""",
)
register(
    "K2_write_scans", lambda s, d: _back(s, tsv.scans_rows(v.scans(s, d).withColumn("hours", F.expr("if(ses % 8 = 0, null, hours)")), v.scans(s, d).filter("ses <= 3").select("filename", "acq_time", "duration", "edf_type"), 5856), "scans"), [v.SCANS],
    "SELECT filename, CASE WHEN ses <= 3 THEN acq_time ELSE (day::date - 5856)::varchar || substr(acq_time, 11) END AS acq_time, CASE WHEN ses <= 3 THEN duration WHEN ses % 8 = 0 THEN 'n/a' ELSE printf('%.4f', hours) END AS duration, edf_type FROM scans",
)
_SIGNALS = lambda s, d: v.table(s, d, "part").selectExpr("p_size as rec", "concat(element_at(array('LAH', 'EKG', 'DC', 'EMG', 'RHc'), cast(p_partkey % 5 as int) + 1), p_partkey % 17) as label", "'uV' as unit", "concat('HP:0.', p_partkey % 7, 'Hz LP:', p_size) as prefilter", "512 as rate")
_CHANNELS = "ch AS (SELECT p_size AS rec, g || (p_partkey % 17) AS name, CASE g WHEN 'EKG' THEN 'ECG' WHEN 'DC' THEN 'TRIG' WHEN 'EMG' THEN 'EMG' ELSE 'SEEG' END AS type, 'μV' AS units, '0.' || (p_partkey % 7) AS low_cutoff, p_size::varchar AS high_cutoff, '512' AS sampling_frequency, g AS \"group\" FROM (SELECT *, (['LAH', 'EKG', 'DC', 'EMG', 'RHc'])[(p_partkey % 5 + 1)::int] AS g FROM part))"
register("K3_write_channels", lambda s, d: _back(s, tsv.channels(_SIGNALS(s, d)), "channels"), [], f"{_CHANNELS} SELECT rec::varchar AS rec, * EXCLUDE (rec) FROM ch")
register("K4_write_electrodes", lambda s, d: _back(s, tsv.electrodes(tsv.channels(_SIGNALS(s, d)), size="2", material="Pt"), "electrodes"), [], f"{_CHANNELS} SELECT rec::varchar AS rec, name, 'n/a' AS x, 'n/a' AS y, 'n/a' AS z, '2' AS size, 'Pt' AS material FROM ch WHERE type = 'SEEG'")
register(
    "K5_write_events", lambda s, d: tsv.events_rows(v.events_tsv(s, d).withColumn("time_abs", F.expr(f"if(seq % 4 = 0, null, date_format(timestamp_micros({_TIMED}), 'HH:mm:ss'))"))), [v.EVENTS_TSV],
    f"SELECT rec, round(onset::decimal(20, 6), 3)::decimal(20, 3)::varchar AS onset, 'n/a' AS duration, CASE WHEN seq % 4 = 0 THEN 'n/a' ELSE strftime(make_timestamp({_TIMED}), '%H:%M:%S') END AS time_abs, 'n/a' AS time_rel, coalesce(nullif(trim(text), ''), 'n/a') AS trial_type FROM events_tsv",
)
register(
    "K6_sidecar_json", lambda s, d: tsv.sidecar(tsv.channels(_SIGNALS(s, d)), ["SEEG", "ECG", "EOG"]), [],
    f"""{_CHANNELS} SELECT rec, '{{"SEEGChannelCount":' || count(*) FILTER (type = 'SEEG') || ',"ECGChannelCount":' || count(*) FILTER (type = 'ECG') || ',"EOGChannelCount":0}}' AS json FROM ch GROUP BY rec""",
)
_LASTS = lambda s, d: v.table(s, d, "part").groupBy(F.col("p_size").alias("rec")).agg(F.expr("concat('clip', count(*) % 3) as task"), (F.count("*") * 0.25).cast("double").alias("hours"))
register(
    "K6_sidecar_full", lambda s, d: tsv.sidecar_json(tsv.channels(_SIGNALS(s, d)), _LASTS(s, d), {"Manufacturer": "M", "PowerLineFrequency": "60"}).select("rec", *[F.get_json_object("json", f"$.{p}").alias(n) for p, n in (("TaskName", "task"), ("Manufacturer", "maker"), ("SamplingFrequency", "rate"), ("HardwareFilters.HighpassFilter['Cutoff (Hz)']", "high"), ("HardwareFilters.LowpassFilter['Cutoff (Hz)']", "low"))], F.regexp_extract("json", '"RecordingDuration":([^,]+)', 1).alias("seconds"), *[F.get_json_object("json", f"$.{p}").alias(n) for p, n in (("SEEGChannelCount", "seeg"), ("TriggerChannelCount", "trig"), ("EOGChannelCount", "eog"))]), [],
    f"""{_CHANNELS}, f AS (SELECT rec, min((name, low_cutoff, high_cutoff)) FILTER (type = 'SEEG') AS first, count(*) FILTER (type = 'SEEG') AS seeg, count(*) FILTER (type = 'TRIG') AS trig, count(*) AS n FROM ch GROUP BY rec)
    SELECT rec, 'clip' || (n % 3) AS task, 'M' AS maker, CASE WHEN first IS NULL THEN 'n/a' ELSE '512' END AS rate, coalesce(first[2], 'n/a') AS high, coalesce(first[3], 'n/a') AS low, (n * 900)::varchar || '.0' AS seconds, seeg::varchar AS seeg, trig::varchar AS trig, '0' AS eog FROM f""",
)
register(
    "K9_split_manifest", lambda s, d: tsv.split_manifest(v.scans(s, d).select("sub", "ses", "filename"), v.files(s, d).filter("ext = '.edf.gz'"), v.files(s, d).filter("ext = '.tsv' and file_id % 2 = 0")), [v.SCANS, v.FILES],
    "SELECT sub, ses, filename FROM scans WHERE (sub, ses) IN (SELECT (sub, ses) FROM files WHERE ext = '.edf.gz') AND (sub, ses) NOT IN (SELECT (sub, ses) FROM files WHERE ext = '.tsv' AND file_id % 2 = 0)",
)
register(
    "P12_bids_root", lambda s, d: m.bids_roots(v.files(s, d).selectExpr("concat(case file_id % 7 when 0 then 'other/notes/' when 1 then '' else concat('study', file_id % 3, '/') end, path) as path")), [v.FILES],
    """p AS (SELECT string_split(CASE file_id % 7 WHEN 0 THEN 'other/notes/' WHEN 1 THEN '' ELSE 'study' || (file_id % 3) || '/' END || path, '/') AS x FROM files)
    SELECT x[1] AS folder, count(DISTINCT x[2]) FILTER (x[2] LIKE 'sub-%') AS subjects, count(DISTINCT x[2] || x[3]) FILTER (x[2] LIKE 'sub-%' AND x[3] LIKE 'ses-%') AS sessions, count(*) FILTER (x[2] LIKE 'sub-%') > 0 AS is_root FROM p GROUP BY 1""",
)
register("P3_channel_kind", lambda s, d: _SIGNALS(s, d).select("label", ev.channel_kind(F.col("label")).alias("generic")).groupBy("label", "generic").count(), [], "SELECT g || (p_partkey % 17) AS label, g = 'DC' AS generic, count(*) AS count FROM (SELECT *, (['LAH', 'EKG', 'DC', 'EMG', 'RHc'])[(p_partkey % 5 + 1)::int] AS g FROM part) GROUP BY ALL")
_NAMES = lambda s, d: v.table(s, d, "customer").filter("c_custkey % 3 = 0").selectExpr("concat('note ', c_custkey % 50) as name").unionByName(v.table(s, d, "nation").selectExpr("lower(n_name) as name"))
register("F3_dictionary_matches", lambda s, d: rd.dictionary(v.events_tsv(s, d).select("rec", "seq", "text"), _NAMES(s, d)).select("rec", "seq", "matches"), [v.EVENTS_TSV],
    "SELECT rec, seq, regexp_extract(text, '(note \\d+)', 1) AS matches FROM events_tsv")
register("F4_dictionary_redact", lambda s, d: rd.dictionary(v.events_tsv(s, d).select("rec", "seq", "text"), _NAMES(s, d), mode="mask").select("rec", "seq", "redacted"), [v.EVENTS_TSV], "SELECT rec, seq, regexp_replace(text, 'note (\\d+)', 'xxxx \\1') AS redacted FROM events_tsv")
_FORMS = lambda f, l, k, first: f"CASE {k} % 4 WHEN 0 THEN concat({f}, '  ', {l}) WHEN 1 THEN concat({l}, ', ', {f}) WHEN 2 THEN concat(' ', {l}, ' ,', {first}, '.') ELSE concat({f}, '_', {l}, '; (', {k} % 30, ')') END"
_LETTERS = lambda k, n: f"translate(cast({k} % {n} as varchar(9)), '0123456789', 'abcdefghij')"
_FIRST, _LAST = f"concat('Fn', {_LETTERS('c_custkey', 40)})", f"concat('Ln', {_LETTERS('c_custkey', 70)})"
register(
    "F5_name_pattern", lambda s, d: v.table(s, d, "customer").selectExpr(f"{_FORMS(_FIRST, _LAST, 'c_custkey', repr('F'))} as name").select("name", phi.name_pattern(F.col("name")).alias("pattern")).distinct(), [],
    f"""SELECT DISTINCT {_FORMS(_FIRST, _LAST, 'c_custkey', repr('F'))} AS name, '(?i){phi.NAME_START}' || CASE c_custkey % 4 WHEN 0 THEN {_FIRST} || '(?:{phi.NAME_SEPARATORS}[A-Za-z]\\.?)?{phi.NAME_SEPARATORS}' || {_LAST} WHEN 3 THEN {_FIRST} || '{phi.NAME_SEPARATORS}' || {_LAST} || '{phi.NAME_SEPARATORS}\\(' || (c_custkey % 30) || '\\)'
    ELSE {_LAST} || '\\s*,\\s*F[A-Za-z]*\\.?' END || '{phi.NAME_END}' AS pattern FROM customer""",
)
register("F6_redact_json", lambda s, d: rd.redact_json(v.table(s, d, "events").selectExpr("event_id", "to_json(named_struct('k', event_type, 'n', user_id, 'x', array(props, event_type))) as doc"), "doc", [("e", "E")]).select("event_id", F.expr("get_json_object(redacted, '$.k')").alias("k"), F.expr("get_json_object(redacted, '$.n')").alias("n")), [], "SELECT event_id, replace(event_type, 'e', 'E') AS k, user_id::varchar AS n FROM events")
_NOTED = lambda s, d: v.events_tsv(s, d).select("rec", "seq", "text")
register("F7_redaction_mask", lambda s, d: _NOTED(s, d).select("rec", "seq", rd.redaction_mask(F.col("text"), F.expr("replace(text, 'note', '')")).alias("mask")).select("rec", "seq", F.expr("aggregate(mask, 0, (a, x) -> a + x)").alias("hidden")), [v.EVENTS_TSV], "SELECT rec, seq, CASE WHEN text LIKE '%note%' THEN 4 ELSE 0 END AS hidden FROM events_tsv")
register("F8_placeholder_redaction", lambda s, d: _NOTED(s, d).select("rec", "seq", rd.placeholder(F.col("text"), rd.redaction_mask(F.col("text"), F.expr("replace(text, 'note', '')"))).alias("text")), [v.EVENTS_TSV], "SELECT rec, seq, replace(text, 'note', '[NAME]') AS text FROM events_tsv")
register("W12_mask_spans", lambda s, d: _NOTED(s, d).select("rec", "seq", F.expr("if(instr(text, 'note') > 0, concat(array_repeat(0, instr(text, 'note') - 1), array(1, 1, 1, 1), array_repeat(0, length(text) - instr(text, 'note') - 3)), array())").alias("mask")).select("rec", "seq", rd.mask_spans(F.col("mask")).alias("spans")).selectExpr("rec", "seq", "get(spans, 0).start as start", "get(spans, 0).stop as stop").filter("start is not null"), [v.EVENTS_TSV], "SELECT rec, seq, (strpos(text, 'note') - 1)::int AS start, (strpos(text, 'note') + 3)::int AS stop FROM events_tsv WHERE text LIKE '%note%'")
register("W11_vote_windows", lambda s, d: tg.vote_windows(v.events_tsv(s, d).selectExpr("rec as doc", "cast(seq * 3 as int) as at", "transform(sequence(0, 5), k -> if((seq + k) % 4 = 0, 1.0D, if((seq + k) % 4 = 1, 0.5D, 0D))) as scores")), [v.EVENTS_TSV],
    "e AS (SELECT rec AS doc, seq * 3 + k AS pos, CASE (seq + k) % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0 END AS p FROM events_tsv, (SELECT unnest(range(0, 6)) AS k)), y AS (SELECT doc, pos FROM e GROUP BY ALL HAVING avg(p) >= 0.5), r AS (SELECT doc, pos, pos - row_number() OVER (PARTITION BY doc ORDER BY pos) AS run FROM y) SELECT doc, min(pos)::int AS start, (max(pos) + 1)::int AS stop FROM r GROUP BY doc, run")
_GIVEN, _FAMILY = "Ann Bo Carla Dmitri Eva Farid Greta Hugo Ines Jonas Kira Liam Mona Nils".split(), "Lee Ray Okoro Petrov Ivanova Garcia Schmidt Tanaka Silva Novak Moreau Haddad".split()


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, with names put in or in a word's place in three of four, and the same with [NAME] there."""
    lines = v.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("line", "text")).filter("length(text) between 20 and 400")
    return rd.augment(lines, [f"{a} {b}" for a in _GIVEN for b in _FAMILY], 5, percent=50, replacing=25)


register("F9_redact_with_model", lambda s, d: tg.redact_with_model(v.texts(s, d), tg.train(_labelled(s, d))))
register("F10_augment", lambda s, d: rd.augment(v.events_tsv(s, d).selectExpr("rec as doc", "seq as line", "text"), ["Ann", "Bo"], 11))
register("F10_replace_and_noise", lambda s, d: rd.augment(v.events_tsv(s, d).selectExpr("rec as doc", "seq as line", "text"), ["Ann Lee", "Bo Ray"], 11, percent=20, replacing=20, noise=True))
register(
    "F11_split_by_case", lambda s, d: rd.split_by_case(v.events_tsv(s, d).select("rec", "seq"), "rec", 5), [v.EVENTS_TSV],
    "SELECT rec, seq, CASE WHEN h < 80 THEN 'train' WHEN h < 90 THEN 'valid' ELSE 'test' END AS split FROM (SELECT rec, seq, ('0x' || substr(md5('5:' || rec), 1, 8))::bigint % 100 AS h FROM events_tsv)",
)
register("A15_char_metrics", lambda s, d: rd.char_metrics(v.table(s, d, "events").selectExpr("transform(sequence(0, 9), k -> if((event_id + k) % 3 = 0, 1, 0)) as truth", "transform(sequence(0, 9), k -> if((event_id + k) % 6 < 2, 1, 0)) as guess")), [],
    """c AS (SELECT sum(((event_id + k) % 3 = 0 AND (event_id + k) % 6 < 2)::int)::bigint AS tp, sum(((event_id + k) % 3 <> 0 AND (event_id + k) % 6 < 2)::int)::bigint AS fp, sum(((event_id + k) % 3 = 0 AND (event_id + k) % 6 >= 2)::int)::bigint AS fn, sum(((event_id + k) % 3 <> 0 AND (event_id + k) % 6 >= 2)::int)::bigint AS tn FROM events, (SELECT unnest(range(0, 10)) AS k)),
    r AS (SELECT *, tp / (tp + fp + 1e-9) AS p, tp / (tp + fn + 1e-9) AS q FROM c) SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(q, 6) AS recall, round(2 * p * q / (p + q + 1e-9), 6) AS f1, round(tn / (tn + fp + 1e-9), 6) AS retention FROM r""")  # fmt: skip
_DOCS = lambda s, d: v.table(s, d, "conversations").selectExpr("conv_id * 1000 + turn as doc", "text as a", "replace(concat(text, '\\nlast'), 'la', 'LA') as b")
register(
    "F19_diff_blocks", lambda s, d: rd.diff_blocks(_DOCS(s, d)), [],
    """l AS (SELECT doc, size, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM (SELECT conv_id * 1000 + turn AS doc, string_split(text, chr(10)) AS x, len(string_split(text, chr(10))) AS size FROM conversations)),
    e AS (SELECT doc, size, i FROM l WHERE contains(line, 'la') UNION ALL SELECT DISTINCT doc, size, size + 1 FROM l), r AS (SELECT *, i - row_number() OVER (PARTITION BY doc ORDER BY i) AS run FROM e),
    b AS (SELECT doc, size, min(i) - 1 AS b_from, max(i) AS b_to FROM r GROUP BY doc, size, run)
    SELECT doc, (row_number() OVER (PARTITION BY doc ORDER BY b_from) - 1)::int AS block, CASE WHEN b_from >= size THEN 'insert' ELSE 'replace' END AS kind, b_from::int AS a_from, least(b_to, size)::int AS a_to, b_from::int AS b_from, b_to::int AS b_to,
    greatest(b_from - 3, 0)::int AS context_from, least(least(b_to, size) + 3, size)::int AS context_to FROM b""",
)
register("J15_redaction_decisions", lambda s, d: rd.merged(_DOCS(s, d), rd.diff_blocks(_DOCS(s, d)).selectExpr("doc", "block", "if(doc % 2 = 0, 'accept', 'discard') as decision")), [], "SELECT conv_id * 1000 + turn AS doc, CASE WHEN (conv_id * 1000 + turn) % 2 = 0 THEN replace(text || chr(10) || 'last', 'la', 'LA') ELSE text END AS text FROM conversations")
register("D1_pattern_table", lambda s, d: v.table(s, d, "events").select("event_id", phi.redact(F.col("props"), [(r"\d+", "#"), ("k", "key")]).alias("props")), [], "SELECT event_id, replace(regexp_replace(props, '\\d+', '#', 'g'), 'k', 'key') AS props FROM events")
register("D2_scorer", lambda s, d: rd.redact_with_model(v.texts(s, d), lambda texts: [[1.0 if c.isdigit() else 0.0 for c in t] for t in texts]), [v.TEXTS], "SELECT doc, text, regexp_replace(text, '[0-9]+', '[NAME]', 'g') AS redacted FROM texts")


def _by_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A query in SQL over these tables, with the table functions."""
    tb.register(spark)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


register("D3_parse_functions", lambda s, d: _by_sql(s, "SELECT cast(rec AS string) AS rec, n.path, n.value FROM note_files, LATERAL parse_notes(content) n", note_files=_ENT(s, d)), [v.EVENTS_TSV],
    "SELECT rec::varchar AS rec, '/' || (3 * seq - 3 + i) || ['/CreationTime', '/Stamp', '/Text'][i + 1] AS path, [(45292 + seq) || '.5', (seq * 10)::varchar, text][i + 1] AS value FROM events_tsv, (SELECT unnest([0, 1, 2]) AS i)")
register(
    "D3_parse_tal", lambda s, d: _by_sql(s, "SELECT rec, t.place, t.onset, t.text FROM list_files, LATERAL parse_tal(content) t WHERE t.text <> ''", list_files=edf.encode_tal(v.events_tsv(s, d))), [v.EVENTS_TSV],
    "SELECT rec, seq::int AS place, onset, text FROM events_tsv WHERE text <> ''",
)
register(
    "D3_parse_diff", lambda s, d: _by_sql(s, "SELECT doc, x.block, x.kind, x.a_from, x.a_to, x.b_from, x.b_to, x.context_from, x.context_to FROM text_pairs, LATERAL diff_lines(a, b, 3) x", text_pairs=_DOCS(s, d)),
)
ORACLES["D3_parse_diff"] = ORACLES["F19_diff_blocks"]
register(
    "D3_relay_pairs", lambda s, d: _by_sql(s, "SELECT rec, seq, pair, current FROM relay_pairs(TABLE(SELECT rec, seq, text FROM relay_events))", relay_events=v.events_tsv(s, d)), [v.EVENTS_TSV],
    """c AS (SELECT *, last_value(CASE WHEN text LIKE 'Closed relay to %' THEN regexp_extract(text, 'to (\\S+)', 1) || '-' || regexp_extract(text, 'and (\\S+)', 1) WHEN text = 'Opened relay' THEN '' END IGNORE NULLS) OVER (PARTITION BY rec ORDER BY seq ROWS UNBOUNDED PRECEDING) AS pair FROM events_tsv)
    SELECT rec, seq, pair, text AS current FROM c WHERE pair <> '' AND regexp_full_match(text, '[0-9]+')""",
)
_CHAN = lambda s, d: v.table(s, d, "part").selectExpr("cast(p_size as bigint) as rec", "p_partkey as idx", "if(p_partkey % 6 = 0, 'Pr', concat('x', p_partkey % 9)) as label")
register(
    "F20_apply_labels", lambda s, d: rd.apply_labels(_CHAN(s, d), _CHAN(s, d).select("rec").distinct().selectExpr("rec", "explode(sequence(1, 10)) as place").selectExpr("rec", "place", "concat('L', place) as label")), [],
    "SELECT p_size::bigint AS rec, p_partkey AS idx, CASE WHEN p_partkey % 6 = 0 THEN 'Pr' WHEN k <= 10 THEN 'L' || k ELSE 'C' || k END AS label FROM (SELECT *, row_number() OVER (PARTITION BY p_size, p_partkey % 6 = 0 ORDER BY p_partkey) AS k FROM part)",
)
_PROMINENT = """list_filter(list_transform(range(2, len({x})), lambda i: {{'i': i, 'high': {x}[i], 'nx': list_min(list_filter(range(i, len({x}) + 1), lambda m: {x}[m] <> {x}[i])), 'lo': coalesce(list_max(list_filter(range(1, i), lambda m: {x}[m] > {x}[i])), 0) + 1,
    'hi': coalesce(list_min(list_filter(range(i, len({x}) + 1), lambda m: {x}[m] > {x}[i])), len({x}) + 1)}}), lambda p: {x}[p['i'] - 1] < p['high'] AND {x}[p['nx']] < p['high'] AND p['high'] - greatest(list_min({x}[p['lo']:p['i']]), list_min({x}[p['i']:p['hi'] - 1])) >= 2000)"""
register(
    "N12_first_peak", lambda s, d: fl.first_peaks(sg.epoch_windows(v.samples(s, d), _EV(s, d), 5, 10).withColumn("values", F.expr("slice(values, 6, 10)")), 0, 2000.0), [v.SAMPLES],
    _EPOCHS + f""", g AS (SELECT rec, channel, event, list(v ORDER BY "offset") FILTER ("offset" >= 0) AS x, list(-v ORDER BY "offset") FILTER ("offset" >= 0) AS y FROM epochs GROUP BY ALL),
    p AS (SELECT rec, channel, event, {_PROMINENT.format(x="x")} AS ups, {_PROMINENT.format(x="y")} AS downs FROM g),
    h AS (SELECT *, coalesce(list_max(list_transform(ups, lambda p: p['high'])), 0) AS high, coalesce(list_max(list_transform(downs, lambda p: p['high'])), 0) AS deep FROM p)
    SELECT rec, channel, event, (ups[1]['i'] + ups[1]['nx'] - 1) // 2 - 1 AS peak, CASE WHEN len(ups) + len(downs) = 0 THEN NULL WHEN high > deep * 1.2 THEN 1 WHEN deep > high * 1.2 THEN -1 END::bigint AS polarity FROM h""",
)
register("R4_live_event_clean", lambda s, d: live.finished(live.clean_events(live.stream(s, d, "events"))).distinct(), [], "SELECT DISTINCT user_id AS subject, event_type || ' ' || props AS text FROM events")
register("R5_live_coverage", lambda s, d: live.latest(live.finished(live.day_coverage(live.stream(s, d, "events")), "update"), ["subject", "day"]), [], "SELECT user_id AS subject, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 4) AS hours FROM events GROUP BY ALL")
_CLOSED = "closed AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 MINUTE AS mark FROM events)"
register(
    "R7_event_sessions", lambda s, d: live.finished(live.event_sessions(live.stream(s, d, "events"))), [_CLOSED],
    """x AS (SELECT user_id AS subject, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 6 HOUR, true)::int AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), b AS (SELECT *, sum(new) OVER (PARTITION BY subject ORDER BY ts) AS burst FROM x)
    SELECT subject, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS n FROM b, closed GROUP BY subject, burst, mark HAVING max(ts) + INTERVAL 6 HOUR <= mark""",
)
register("R3_stall_detector", lambda s, d: live.finished(live.stalls(live.stream(s, d, "events").selectExpr("ts", "concat('f', user_id % 20) as file", "value as size"), 60.0)), [_CLOSED],
    """w AS (SELECT 'f' || (user_id % 20) AS file, value, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 3 HOUR AS start FROM events, (SELECT unnest([0, 1]) AS k))
    SELECT file, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, round(max(value) - min(value), 6) AS grown FROM w, closed GROUP BY file, w.start, mark HAVING w.start + INTERVAL 6 HOUR <= mark AND max(value) - min(value) < 60""")  # fmt: skip
_SIZED = "concat('f', user_id % 20, if(event_id % 500 = 7, '(1)', ''), '.edf') as file"
register(
    "R3_stall_states", lambda s, d: live.finished(live.stall_states(live.stream(s, d, "events").selectExpr(_SIZED, "ts", "cast(value * 1000 as bigint) as size"), 0.001, 7200.0, forget_s=400 * 86400)), [_CLOSED],
    """e AS (SELECT 'f' || (user_id % 20) || '.edf' AS file, epoch_us(ts) AS us, trunc(value * 1000)::bigint AS size, event_id % 500 = 7 AS copy FROM events, closed WHERE date_trunc('millisecond', ts) < mark),
    c AS (SELECT file, min((us, size)) AS copied FROM e WHERE copy GROUP BY file), x AS (SELECT e.*, copied FROM e LEFT JOIN c USING (file) WHERE copied IS NULL OR (us, size) < copied),
    g AS (SELECT *, coalesce(size - lag(size) OVER w >= 0.001::double * ((us - lag(us) OVER w) / 1e6::double), true) AS grew, lag(us) OVER w IS NULL AS opens FROM x WINDOW w AS (PARTITION BY file ORDER BY us, size)),
    r AS (SELECT *, sum(grew::int) OVER (PARTITION BY file ORDER BY us, size) AS run FROM g), q AS (SELECT *, round((us - min(us) OVER (PARTITION BY file, run)) / 1e6::double, 6) AS quiet_s FROM r),
    s AS (SELECT file, run, arg_min((us, quiet_s, size), (us, size)) AS first FROM q WHERE NOT grew AND quiet_s >= 7200 GROUP BY file, run)
    SELECT file, first[1] AS us, 'stalled' AS state, first[2] AS quiet_s, first[3] AS size FROM s UNION ALL SELECT q.file, us, 'growing', 0.0, size FROM q JOIN s ON s.file = q.file AND s.run = q.run - 1 WHERE grew
    UNION ALL SELECT c.file, c.copied[1], 'replicated', coalesce(l.quiet_s, 0), coalesce(l.size, NULL) FROM c LEFT JOIN (SELECT file, arg_max(quiet_s, (us, size)) AS quiet_s, arg_max(size, (us, size)) AS size FROM q GROUP BY file) l USING (file)""",
)
_LISTED = lambda s, d: live.stream(s, d, "events").selectExpr("concat('f', user_id) as path", "cast(floor(value / 60) as bigint) as size", "unix_timestamp(ts) as at", "unix_timestamp(ts) - event_id % 5 * 600 as modified")
register(
    "R2_ready_files", lambda s, d: live.finished(live.ready_files(_LISTED(s, d), 3600, 600, v.table(s, d, "events").filter("user_id % 10 = 3").selectExpr("concat('f', user_id) as path").distinct())), [],
    """e AS (SELECT 'f' || user_id AS path, floor(value / 60)::bigint AS size, epoch_us(ts) // 1000000 AS s, event_id % 5 * 600 AS age FROM events WHERE user_id % 10 <> 3),
    x AS (SELECT *, coalesce(size <> lag(size) OVER w OR s - lag(s) OVER w > 86400, true)::int AS new FROM e WINDOW w AS (PARTITION BY path ORDER BY s, size, -age)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY path ORDER BY s, size, -age ROWS UNBOUNDED PRECEDING) AS run FROM x), f AS (SELECT *, min(s) OVER (PARTITION BY path, run) AS since FROM r)
    SELECT path, size, min(s) AS "at" FROM f WHERE s - since >= 3600 AND age >= 600 GROUP BY path, run, size""",
)
register("R6_live_relay_decoder", lambda s, d: live.finished(live.relay_stream(live.stream(s, d, "events").selectExpr("user_id as rec", "ts", "event_id as seq", "case event_id % 7 when 0 then concat('Closed relay to A', event_id % 5, ' and B1') when 1 then 'Opened relay' when 2 then '5' else if(event_id % 2 = 0, '7', 'note') end as text"))), [_CLOSED],
    """t AS (SELECT user_id AS rec, ts, event_id AS seq, CASE event_id % 7 WHEN 0 THEN 'Closed relay to A' || (event_id % 5) || ' and B1' WHEN 1 THEN 'Opened relay' WHEN 2 THEN '5' ELSE CASE WHEN event_id % 2 = 0 THEN '7' ELSE 'note' END END AS text FROM events),
    c AS (SELECT *, last_value(CASE WHEN text LIKE 'Closed%' THEN 'A' || (seq % 5) || '-B1' WHEN text LIKE 'Opened%' THEN '' END IGNORE NULLS) OVER (PARTITION BY rec ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS pair FROM t)
    SELECT rec, seq, pair, text AS current FROM c, closed WHERE date_trunc('millisecond', ts) < mark AND pair <> '' AND text IN ('5', '7')""")  # fmt: skip
_MARKS = lambda s, d: v.table(s, d, "documents").selectExpr("cast(doc_id as string) as path", "doc_id % 3 = 0 as passed", "if(doc_id % 2 = 0, true, null) as done")
register("R1_watch_folder", lambda s, d: live.finished(live.watch(live.stream(s, d, "documents").selectExpr("cast(doc_id as string) as path"), _MARKS(s, d))), [], "SELECT doc_id::varchar AS path FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 1")
register("R8_rescan_loop", lambda s, d: live.finished(live.rescan(live.stream(s, d, "documents").selectExpr("concat(doc_id % 40, '/', doc_id % 3) as path"), v.table(s, d, "documents").filter("doc_id % 4 = 0").selectExpr("concat(doc_id % 40, '/', doc_id % 3) as path").distinct())), [],
    "SELECT DISTINCT (doc_id % 40) || '/' || (doc_id % 3) AS path FROM documents WHERE (doc_id % 40) || '/' || (doc_id % 3) NOT IN (SELECT (doc_id % 40) || '/' || (doc_id % 3) FROM documents WHERE doc_id % 4 = 0)")
