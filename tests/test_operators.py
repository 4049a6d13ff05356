"""Hand-written cases: traps of the rules, round trips and properties that the tables don't show."""

import math
import random
import re
import time

import pytest
import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import phi, redaction, scalar
from tidemark.operators import events, filters, intervals, joins, manifest
from tidemark.plans import renumber
from tidemark.sources import edf


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def test_union_and_simple_coverage_differ(spark):
    s = spark.createDataFrame([(1, "a", 0, 7200), (1, "b", 3600, 10800), (1, "c", 10800, 14400), (1, "d", 20000, 18000), (1, "e", 86400 * 2, 86400 * 2 + 10), (1, "z", 5, 5)], "subject long, name string, s long, e long")
    union = {r.day: (r.n_sessions, r.union_s, r.overlap, r.below) for r in intervals.coverage_union_by_day(s).collect()}
    assert union == {0: (4, 14400 + 2000, True, False), 2: (1, 10, False, False)}
    simple = {r.day: (r.seconds, r.missing) for r in intervals.coverage_simple(s).collect()}
    assert simple == {0: (7200 + 7200 + 3600 + 2000, False), 1: (0, True), 2: (10, False)}
    assert [r.names for r in intervals.coverage_overlaps(s).collect()] == ["a,b"]
    total = intervals.interval_union(s).first()
    assert (total.n_intervals, total.total_s) == (3, 14400 + 2000 + 10)


def test_redaction_is_stable(spark):
    texts = ["mail a.b@c.org, +1 555-123-4567", "on 2024-01-05 or 3/4/99", "id 1234567 é1234567", None, "a\tb c\x07"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r.x for r in df.select(phi.redact(F.col("t")).alias("x")).collect()]
    assert out[0] == "mail [REDACTED_EMAIL], +[REDACTED_PHONE]" and out[1] == "on [REDACTED_DATE] or [REDACTED_DATE]"
    assert out[2] == "id [REDACTED_ID] é1234567" and out[3] == "" and out[4] == "abc"
    again = [r.x for r in spark.createDataFrame([(t,) for t in out], "t string").select(phi.redact(F.col("t")).alias("x")).collect()]
    assert again == out


def test_dictionary_takes_the_longest_first(spark):
    df = spark.createDataFrame([(1, "Ann Lee met annabel"), (2, None), (3, "İ Ann")], "doc long, text string")
    names = spark.createDataFrame([("Ann",), ("Ann Lee",), ("annabel",), ("",), (None,)], "name string")
    out = {r.doc: (r.matches, r.redacted) for r in redaction.dictionary(df, names).collect()}
    assert out[1] == ("Ann Lee|annabel", ".X. met .x.") and out[2] == ("", "") and out[3] == ("Ann", "İ .X.")
    masked = redaction.dictionary(df, names, mode="mask").filter("doc = 1").first().redacted
    assert masked == "Xxx Xxx met xxxxxxx"
    assert redaction.dictionary(df, names.limit(0)).filter("doc = 1").first().matches == ""


def test_tal_round_trip(spark):
    raw = b"+0.25\x14\x14\x00+1.5\x1530\x14Seizure\x14Second\x14\x00+2\x14open\x00+1.5\x1530\x14Seizure\x14\x00-3\x14a\nb\x14\x00+9\x14 \x14\x00"
    df = spark.createDataFrame([("f", bytearray(raw))], "path string, content binary")
    rows = sorted((r.onset, r.duration, r.text) for r in edf.annotations(df, "path").collect())
    assert rows == [(-3.25, None, "ab"), (1.25, 30.0, "Second"), (1.25, 30.0, "Seizure"), (1.75, None, "open")]
    blank = bytes(df.select(edf.blank_tal(F.col("content")).alias("b")).first().b)
    assert len(blank) == len(raw) and b"Seizure" not in blank and b"open" not in blank and blank.count(b"\x14") == raw.count(b"\x14") and b"+1.5\x1530" in blank


def test_int24_samples(spark):
    head = b"0".ljust(8) + b"X".ljust(80) + b"R".ljust(80) + b"01.01.84" + b"00.00.00" + b"512".ljust(8) + b"24BIT".ljust(44) + b"-1".ljust(8) + b"1".ljust(8) + b"1".ljust(4)
    head += b"A".ljust(16) + b" " * 80 + b"uV".ljust(8) + b"-8388608" + b"8388607".ljust(8) + b"-8388608" + b"8388607".ljust(8) + b" " * 80 + b"3".ljust(8) + b" " * 32
    values = [1, -1, 8388607, -8388608, 0, 5]
    df = spark.createDataFrame([("f", bytearray(head + b"".join((v & 0xFFFFFF).to_bytes(3, "little") for v in values) + b"\x01"))], "path string, content binary")
    assert edf.header(df).first().n_records == 2
    got = [x for r in sorted(edf.samples(df).collect(), key=lambda r: r.record) for x in r["values"]]
    assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(got, values, strict=True))


def test_header_dates(spark):
    assert one(spark, scalar.edf_datetime(F.lit("02.01.84"), F.lit("03.04.05"))) == "2084-01-02T03:04:05"
    assert one(spark, scalar.edf_datetime(F.lit("02.01.85"), F.lit("03.04.05"))) == "1985-01-02T03:04:05"
    assert one(spark, scalar.sec2time(F.lit(-90_061_000_001))) == "-1 days, 01:01:01.000001"
    assert one(spark, scalar.parse_size(F.lit("751.9 kb"))) == round(751.9 * 1024) and one(spark, scalar.parse_size(F.lit("x"))) is None


def test_shift_back_is_identity(spark):
    scans = spark.createDataFrame([(1, n, f"ses-{n:03d}/sub-001_ses-{n:03d}.edf") for n in range(1, 30)], "sub long, ses long, filename string")
    there = renumber.shift_sessions(scans, 5, 29, 40)
    back = renumber.shift_sessions(there.selectExpr("sub", "new_ses as ses", "new_filename as filename"), 45, 69, -40)
    assert sorted(r.new_filename for r in back.collect()) == sorted(r.filename for r in scans.collect())
    assert renumber.shift_sessions(scans, 5, 5, 1).filter("collision").count() == 2
    for action in ("increment", "decrement", "delete"):
        out = {r.ses: r.new_ses for r in renumber.edit_sessions(scans, action, 1).collect()}
        assert out.get(1) == {"increment": 2, "decrement": 1, "delete": None}[action]


def test_manifest_errors(spark):
    with pytest.raises(ValueError, match="acq_time"):
        manifest.validate_scans_columns(spark.createDataFrame([("a", "b")], "filename string, duration string"))
    with pytest.raises(ValueError, match="repeats"):
        manifest.first_appearance(spark.createDataFrame([(1, 1), (1, 2)], "id long, idx long"), "id", "idx", "error")


def test_relay_and_gap(spark):
    rows = [(1, 1, 0.0, "Closed relay to A and B"), (1, 2, 1.0, " 3 "), (1, 3, 2.0, "Opened relay"), (1, 4, 3.0, "4"), (1, 5, 10.0, "Start Stimulation from X1 to X2"), (1, 6, 30.0, "5"), (1, 7, 40.0, "high freq"), (1, 8, 41.0, "Start Stimulation from Y1 to Y2"), (1, 9, 42.0, "2")]
    df = spark.createDataFrame(rows, "rec long, seq long, onset double, text string")
    assert [(r.seq, r.pair, r.current) for r in events.relay_state(df).collect()] == [(2, "A-B", "3")]
    assert [(r.pair, r.currents) for r in events.manual_stims(df).collect()] == [("A-B", "3,4")]  # a gap of just 20 s and a high-frequency line don't count


def test_set_compare_ignores_order_and_blanks(spark):
    a = spark.createDataFrame([("x", "1"), ("y", None), ("x", "1")], "k string, v string")
    b = spark.createDataFrame([("y", None), (" x ", "1")], "k string, v string")
    assert joins.set_compare(a, b, ["k", "v"]).first().equal


def test_coverage_rows_take_seconds_and_bad_times(spark):
    rows = [("a", "1704096000", "1,5"), ("b", "2024-01-01T08:00:00", "1"), ("c", "yesterday", "1"), ("d", None, "1"), (" ", "1704096000.7", "n/a"), ("e", "1704096000", "-1")]
    df = spark.createDataFrame(rows, "filename string, acq_time string, duration string")
    assert sorted(tuple(r) for r in manifest.coverage_rows(df).collect()) == [("a", 1704096000, 1704101400), ("b", 1704096000, 1704099600)]
    assert [r.label for r in manifest.coverage_rows(df, "label", 1).collect()] == ["a"]


def test_masks(spark):
    df = spark.createDataFrame([("Jane ok", "[NAME] ok"), ("a\r\nb", "a\nb"), ("same", "same"), ("x 12 y", "x  y"), (None, None)], "a string, b string")
    out = [(r.m, r.t) for r in df.withColumn("m", redaction.redaction_mask(F.col("a"), F.col("b"))).withColumn("t", redaction.placeholder(F.col("a"), F.col("m"))).collect()]
    assert out[0][1].endswith(" ok") and "[NAME]" in out[0][1] and sum(out[1][0]) == 0 and out[2] == ([0, 0, 0, 0], "same") and out[3][1] == "x 12 y"


def test_first_peak_takes_all_recordings(spark):
    from tidemark import queries

    assert queries.QUERIES["N12_first_peak"](spark, "/root/testdata/sf0.001").filter("rec >= 8").count() > 0


def rows_of(spark, signal):
    return spark.createDataFrame([(1, 1, i, float(x)) for i, x in enumerate(signal)], "rec long, channel long, idx long, v double")


def test_cubic_is_the_fit_of_numpy(spark):
    rng = np.random.default_rng(4)
    for n, most in ((60, 1e-3), (60, 1e9), (4, 1e9)):
        x = np.arange(n)
        v = 5 + 0.2 * x - 0.01 * x**2 + 0.05 * x**3 + rng.normal(size=n)
        fit = np.polyfit(x, v, 3)
        fit[0] = np.clip(fit[0], -most, most)
        got = [r.rest for r in filters.detrend_cubic(rows_of(spark, v), most).orderBy("idx").collect()]
        assert np.allclose(got, v - np.polyval(fit, x), atol=1e-6)
    assert [r.rest for r in filters.detrend_cubic(rows_of(spark, [1, 2, 4])).collect()] == [None] * 3


def test_windows_over_spans_are_those_over_channels(spark):
    v = np.random.default_rng(5).normal(size=50)
    padded = np.pad(v, 2)
    want = [sorted(padded[i : i + 5])[2] for i in range(50)]
    assert [r.median for r in filters.median_filter(rows_of(spark, v), 5).orderBy("idx").collect()] == want
    small = filters.spans(rows_of(spark, v), 2, 7).withColumn("m", F.expr("sum(v) over (partition by rec, channel, span order by idx rows between 2 preceding and 2 following)")).filter("home = span").orderBy("idx").collect()
    assert np.allclose([r.m for r in small], [padded[i : i + 5].sum() for i in range(50)])


def test_orientation_and_slopes(spark):
    v = np.random.default_rng(6).normal(size=30)
    v[9] = np.nan
    events_ = spark.createDataFrame([(1, e) for e in range(31)], "rec long, event long")
    out = {r.event: r for r in filters.orientation(rows_of(spark, v), events_, 3, 6).collect()}
    assert sorted(out) == list(range(30)) and out[0][3:] == (None, 0.0, 0.0)
    for e in range(1, 30):
        want = None if e + 3 > 29 else -1 if np.nansum(v[[e, e + 3]]) < 0 else 1
        pre, post = v[max(0, e - 6) : e], v[e : e + 6]
        assert out[e].orientation == want
        if not max(0, e - 6) <= 9 <= e + 5:  # a window with NaN inside
            assert np.allclose([out[e].pre, out[e].post], [np.mean(np.diff(w)) if len(w) > 1 else 0 for w in (pre, post)])


def test_peaks_of_all_kinds(spark):
    v = [5, 1, 2, 6, 6, 2, 0, 9, 1, 3, 8]
    at = lambda **k: [(r.idx, r.v) for r in filters.find_peaks(rows_of(spark, v), **k).orderBy("idx").collect()]
    assert at(sel=1, thresh=2) == [(3, 6.0), (4, 6.0), (7, 9.0), (10, 8.0)]
    assert at(sel=-1, thresh=2)[0] == (0, 5.0) and at(sel=1, thresh=2, endpoints=False)[-1] == (7, 9.0)
    assert len(at(sel=1, thresh=2, least=2, most=2)) == 4 and at(sel=1, thresh=2, least=3) == [] and at(sel=-1, thresh=-1.5, extrema=-1, endpoints=False) == [(1, 1.0), (6, 0.0), (8, 1.0)]
    wide = rows_of(spark, [0, 2, 4, 9, 4, 1, 7, 0])  # widths 5 and 2
    assert [r.idx for r in filters.find_peaks(wide, sel=1, thresh=1, least=3).collect()] == [3] and [r.idx for r in filters.find_peaks(wide, sel=1, thresh=1, most=3).collect()] == [6]
    top = filters.find_peaks(rows_of(spark, [0, 3, 5, 4, 0]), sel=1, thresh=1).first()
    assert top.place == pytest.approx(2 + 0.5 * (3 - 4) / (3 - 10 + 4))


def test_first_peak_sees_its_window_only(spark):
    v = [9, 0, 3, 3, 1, 5, 0, -8, 0, 20]
    epochs = spark.createDataFrame([(1, 1, 0, o - 2, float(x)) for o, x in enumerate(v)] + [(1, 1, 1, -2, 1.0)], "rec long, channel long, event long, offset long, v double")
    out = {r.event: (r.peak, r.polarity) for r in filters.first_peak(epochs, -1, 6, 2.0).collect()}
    assert out == {0: (0, -1), 1: (None, None)}
    assert filters.first_peak(epochs, -1, 6, 3.0).filter("event = 0").first().peak == 3


def test_name_patterns(spark):
    cases = [
        ("Jane Doe", "saw jane Q. doe today", True), ("Jane Doe", "jane_doe", True), ("Jane Doe", "xjane doe", False), ("Jane Doe", "Jane Doest", False), ("Doe, J.", "Doe, Janet", True), ("Doe, Jane", "(doe , j)", True),
        ("Doe, Jane", "Doe, Karl", False), ("Mary Ann O'Neil", "mary-ann_o'neil.", True), ("A+ B. C", "a+ b c", True), ("A+ B. C", "aa b c", False),
    ]
    df = spark.createDataFrame(cases, "name string, text string, hit boolean")
    assert [r.hit for r in df.select("text", phi.name_pattern(F.col("name")).alias("p")).select(F.expr("rlike(text, p)").alias("hit")).collect()] == [c[2] for c in cases]


def test_augment_keeps_counterparts(spark):
    lines = spark.range(400).selectExpr("id % 7 as doc", "id as line", "if(id % 10 = 0, '', concat('w', id, ' of  text ', id)) as text")
    out = redaction.augment(lines, ["Ann Lee", "Bo"], 3, percent=30, replacing=30, noise=True).collect()
    before = {r.line: r.text for r in lines.collect()}
    put, replaced = 0, 0
    for r in out:
        if r.text == before[r.line]:
            assert r.label == r.text
            continue
        a, b = r.label.split("[NAME]")
        assert r.text.startswith(a) and r.text.endswith(b) and before[r.line]
        more = len(r.label.split(" ")) - len(before[r.line].split(" "))
        put, replaced = put + (more == 1), replaced + (more == 0)
    assert 60 < put < 160 and 60 < replaced < 160 and put + replaced < 360
    again = redaction.augment(lines.repartition(5), ["Ann Lee", "Bo"], 3, percent=30, replacing=30, noise=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out))


def test_diff_context_and_report_of_bounds(spark):
    a = "\n".join(str(i) for i in range(10))
    pair = spark.createDataFrame([(1, a, a.replace("5", "x"))], "doc long, a string, b string")
    assert tuple(redaction.diff_blocks(pair).first()) == (1, 0, "replace", 5, 6, 5, 6, 2, 9)
    rows = [(1, 1, 0.5, None), (1, 2, 7.0, None), (2, 1, None, None), (3, 1, 0.0, None), (3, 2, 1.0, "2024-01-02 08:05:09"), (3, 3, 2.0, "2024-01-02 20:00:00")]
    df = spark.createDataFrame(rows, "rec long, seq long, onset double, time string").withColumn("time", F.expr("cast(time as timestamp)"))
    assert sorted(tuple(r) for r in events.bounds_report(df).collect()) == [
        (1, "0.5 s", "7.0 s", "N/A"), (2, "N/A", "N/A", "N/A"), (3, "2024-01-02 08:05:09", "2024-01-02 20:00:00", "2024-01-02\t8:05:09 AM\t8:00:00 PM"),
    ]


def test_dictionary_in_turns_is_that_at_once(spark):
    names = spark.createDataFrame([(x,) for x in ("ab", "bc", "abcd", "de", "ef", "cd", "zz", "", None, "ab")], "name string")
    df = spark.createDataFrame([(1, "Abcdef bcde"), (2, "xefzz"), (3, None), (4, "")], "doc long, text string")
    at_once = sorted(map(tuple, redaction.dictionary(df, names).select("doc", "matches", "redacted").collect()))
    assert at_once[0] == (1, "Abcd|ef|bc|de", ".X..x. .x..x.") and at_once[2:] == [(3, "", ""), (4, "", "")]
    for most in (1, 3):
        assert sorted(map(tuple, redaction.dictionary(df, names, most=most).select("doc", "matches", "redacted").collect())) == at_once


def test_changes_of_long_texts(spark):
    """Words blotted out of long texts are found again, in a time that doesn't grow with the square of the length."""
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(300)}" for _ in range(30_000)]
    gone = set(rnd.sample(range(len(words)), 600))
    text, left = " ".join(words), " ".join("[NAME]" if i in gone else w for i, w in enumerate(words))
    began = time.time()
    mask = redaction.mask_of(text, left)
    assert time.time() - began < 20
    at, hidden = 0, 0
    for i, w in enumerate(words):
        hidden += i in gone and sum(mask[at : at + len(w)]) == len(w)
        at += len(w) + 1
    assert hidden == 600 and sum(mask) < 1.2 * sum(len(words[i]) for i in gone)
    other = " ".join(f"v{rnd.randrange(300)}" for _ in range(30_000))  # nothing in common but blanks and digits
    assert len(redaction.mask_of(text, other)) == len(text) and time.time() - began < 60
    for a, b in (("", ""), ("", "x"), ("a b", ""), ("a\r\nb", "a\nb"), ("abc", "abc")):
        assert sum(redaction.mask_of(a, b)) == (len(a) if not b else 0)
    for _ in range(300):  # what changes() leaves is the same in both
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(12))] for _ in range(2))
        built, i = [], 0
        for _kind, lo, hi, x, y in redaction.changes(a, b):
            built += a[i:lo] + b[x:y]
            i = hi
        assert built + a[i:] == b


def test_model_redaction_is_that_of_whole_texts(spark):
    """F9, D2: windows, votes and runs against a plain loop over each text."""
    texts = ["", "no names", "Jane Doe met Bo Ray. " * 60, "x" * 700 + " Ann Lee", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    for size, stride in ((512, 256), (64, 48)):
        for r in redaction.redact_with_model(df, size=size, stride=stride).collect():
            t = r.text
            if t is None:
                assert r.redacted is None
                continue
            score, votes = [0.0] * len(t), [0] * len(t)
            for at in range(0, max(len(t), 1), stride):
                for k, p in enumerate(redaction.pattern_scorer([t[at : at + size]])[0]):
                    score[at + k] += p
                    votes[at + k] += 1
            hit = "".join("1" if v and s / v >= 0.5 else "0" for s, v in zip(score, votes, strict=True))
            plain, end = "", 0
            for m in re.finditer("1+", hit):
                plain += t[end : m.start()] + "[NAME]"
                end = m.end()
            assert r.redacted == plain + t[end:]


def test_bids_roots(spark):
    paths = ["a/sub-1/ses-1/ieeg/x.edf", "a/sub-1/ses-2/x.tsv", "a/sub-2/x.tsv", "a/sub-3", "b/notes/sub-1/ses-1/x.edf", "b/sub-é/x", "readme", "", None]
    out = manifest.bids_roots(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert {tuple(r) for r in out} == {("a", 2, 2, True), ("b", 0, 0, False), ("readme", 0, 0, False), ("", 0, 0, False), (None, 0, 0, False)}


def test_blocks_are_those_of_the_standard_matcher():
    from difflib import SequenceMatcher

    from tidemark.functions import blocks

    rnd, before = random.Random(9), blocks.CELLS
    try:
        for _ in range(400):
            blocks.CELLS = rnd.choice([0, 16, before])
            letters = rnd.choice([1, 2, 3, 5, 30])
            a = [rnd.randrange(letters) for _ in range(rnd.randrange(150))]
            b = [rnd.randrange(letters) for _ in range(rnd.randrange(150))] if rnd.random() < 0.5 else [x for x in a if rnd.random() < 0.8]
            assert blocks.changes(a, b) == [o for o in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if o[0] != "equal"]
            assert [x for x in blocks.matching_blocks(a, b)] == [tuple(m) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()[:-1]]
    finally:
        blocks.CELLS = before
    x, y = ["x", "y"] * 150, ["y", "x"] * 151
    assert sum(m[2] for m in blocks.matching_blocks(x, y)) == 300
    began = time.time()
    other = [f"w{i // 2}" if i % 2 else f"b{i}" for i in range(20_000)]
    assert len(blocks.matching_blocks([f"w{i // 2}" if i % 2 else f"a{i}" for i in range(20_000)], other)) == 10_000
    blocks.matching_blocks([rnd.randrange(3) for _ in range(20_000)], [rnd.randrange(3) for _ in range(20_000)])
    assert time.time() - began < 20


def test_first_peaks_against_definition():
    r = np.random.default_rng(2)

    def peaks(x, least):
        out = []
        for i in range(1, len(x) - 1):
            after = next((m for m in range(i, len(x)) if x[m] != x[i]), None)
            if after is not None and x[i - 1] < x[i] and x[after] < x[i]:
                lo = max((m for m in range(i) if x[m] > x[i]), default=-1) + 1
                hi = min((m for m in range(i, len(x)) if x[m] > x[i]), default=len(x))
                if x[i] - max(min(x[lo : i + 1]), min(x[i:hi])) >= least:
                    out.append((i, after))
        return out

    for _ in range(60):
        x = r.integers(0, r.integers(2, 12), (10, r.integers(1, 30))).astype(float)
        place, sign = filters.peaks_of(x, 2.0)
        for k, row in enumerate(x):
            ups, downs = peaks(row, 2), peaks(-row, 2)
            high, deep = max((row[i] for i, _ in ups), default=0), max((-row[i] for i, _ in downs), default=0)
            assert place[k] == ((ups[0][0] + ups[0][1] - 1) // 2 if ups else -1)
            assert sign[k] == (0 if not ups + downs else 1 if high > deep * 1.2 else -1 if deep > high * 1.2 else 0)


def test_epoch_windows_are_epochs(spark):
    from tidemark.operators import signals

    samples = spark.createDataFrame([(r, c, i, float((i * 37 + c * 11) % 101)) for r in (1, 2) for c in (1, 2) for i in range(40 + 30 * c)], "rec long, channel long, idx long, v double")
    at = spark.createDataFrame([(r, e) for r in (1, 2, 3) for e in (0, 2, 3, 15, 16, 17, 63, 64, 65, 66, 95, 96, 97, 98, 99, 100)], "rec long, event long")
    want = {}
    for r in signals.epoch_events(samples, at, 3, 4).collect():
        want.setdefault((r.rec, r.channel, r.event), {})[r.offset] = r.v
    for block in (8, 16, 1024):
        got = {(r.rec, r.channel, r.event): r["values"] for r in signals.epoch_windows(samples, at, 3, 4, block).collect()}
        assert got == {k: [v[o] for o in sorted(v)] for k, v in want.items()}


@pytest.mark.parametrize("size", [7, 64, 1 << 16])
def test_spans_give_the_same_peaks_and_states(spark, size):
    r = random.Random(3)
    values = [(rec, c, i, float(r.randrange(6))) for rec in (1, 2) for c in (1, 2) for i in range(90 * c)]
    samples = spark.createDataFrame(values, "rec long, channel long, idx long, v double").repartition(3)
    for kw in ({"sel": 1.0, "thresh": 1.0}, {"sel": 0.5, "thresh": -9.0, "extrema": -1, "least": 2, "most": 5}, {"endpoints": False, "least": 1}):
        got = sorted((p.rec, p.channel, p.idx, round(p.place, 6), p.v) for p in filters.find_peaks(samples, size=size, **kw).collect())
        assert got == plain_peaks(values, **kw)
    said = ["Closed relay to A and B", "Opened relay", "3", "x", "Start Stimulation from C to D", "high freq", " 7 ", None]
    rows = [(rec, i + 1, float(i * r.choice([1, 30])), r.choice(said)) for rec in (1, 2) for i in range(150)]
    notes = spark.createDataFrame(rows, "rec long, seq long, onset double, text string")
    for f in (events.relay_state, events.manual_stims):
        assert sorted(map(tuple, f(notes, size=size).collect()), key=repr) == sorted(map(tuple, f(notes, size=1 << 20).collect()), key=repr)


def plain_peaks(values, sel=None, thresh=None, extrema=1, endpoints=True, least=None, most=None):
    out = []
    for key in sorted({v[:2] for v in values}):
        x = [v[3] * extrema for v in sorted(values) if v[:2] == key]
        quarter = (max(x) - min(x)) / 4
        slope = [(b > a) - (b < a) for a, b in zip(x, x[1:])]
        for i, top in enumerate(x):
            before, after = slope[i - 1] if i else None, slope[i] if i < len(slope) else None
            end = endpoints and ((before is None and after == -1) or (after is None and before == 1))
            if not (end or (before is not None and after is not None and after < before)):
                continue
            if not (top > (quarter if thresh is None else thresh) and top - min(x[: i + 1]) > (quarter if sel is None else sel)):
                continue
            rise = max((j + 1 for j in range(i) if slope[j] <= 0), default=0)
            fall = min((j for j in range(i, len(slope)) if slope[j] >= 0), default=len(x) - 1)
            if (least is not None and fall - rise < least) or (most is not None and fall - rise > most):
                continue
            inner = 0 < i < len(x) - 1
            place = i + 0.5 * (x[i - 1] - x[i + 1]) / (x[i - 1] - 2 * top + x[i + 1]) if inner else float(i)
            out.append((*key, i, round(place, 6), top * extrema))
    return sorted(out)


@pytest.mark.parametrize("bucket", [5, 1000])
def test_interval_union_by_buckets(spark, bucket):
    r = random.Random(6)
    rows = [(s, a := r.randrange(300), a + r.choice([0, 1, 5, -9, 40, 200])) for s in (1, 2, 3) for _ in range(60)] + [(4, None, 3), (4, 1, None), (5, 7, 7), (6, 3, 4), (6, 3, 4)]
    got = {u.subject: (u.n_intervals, u.total_s) for u in intervals.interval_union(spark.createDataFrame(rows, "subject long, s long, e long"), bucket_s=bucket).collect()}
    want = {}
    for subject in {x[0] for x in rows}:
        spans = sorted((min(s, e), max(s, e)) for k, s, e in rows if k == subject and s is not None and e is not None and s != e)
        n = total = 0
        reach = None
        for s, e in spans:
            n += reach is None or s > reach
            total += max(0, e - (s if reach is None else max(s, reach)))
            reach = e if reach is None else max(reach, e)
        if spans:
            want[subject] = (n, total)
    assert got == want


def test_best_shift_against_all_slices():
    r = np.random.default_rng(5)
    for _ in range(300):
        n = int(r.integers(1, 12))
        short, notes = np.sort(r.integers(0, 60, n)).astype(float), np.sort(r.integers(0, 90, n + int(r.integers(0, 20)))).astype(float)
        scores = [round(float((((short - short[0]) - (notes[s : s + n] - notes[s])) ** 2).sum()), 6) for s in range(len(notes) - n + 1)]
        assert events.best_shift(short, notes) == scores.index(min(scores))
    notes = np.cumsum(r.exponential(3.0, 200_000))
    began = time.time()
    assert events.best_shift(notes[70_000:170_000] + 123.0, notes) == 70_000 and time.time() - began < 10


def test_size_classes(spark):
    a = spark.createDataFrame([(f"a{i}", i % 4) for i in range(12)] + [("n", None)], "path string, length long")
    b = spark.createDataFrame([(f"b{i}", i % 3) for i in range(9)], "path string, length long")
    rows = joins.size_classes(a, b).collect()
    assert len(rows) == 18 and all((r.members, r.partners) == (3, 3) for r in rows) and {r.length for r in rows} == {0, 1, 2}
    pairs = joins.match_by_size(a, b).collect()
    assert len(pairs) == 27 and len({(p.path_a, p.path_b) for p in pairs}) == 27


def test_legal_tags_against_all_sequences():
    from itertools import product

    from tidemark.functions import tagging

    r = np.random.default_rng(4)
    for n in (1, 2, 3, 5):
        for _ in range(60):
            scores = np.round(r.normal(0, 1, (n, 3)), 1)
            legal = [p for p in product(range(3), repeat=n) if all(t != tagging.I or (i and p[i - 1] != tagging.O) for i, t in enumerate(p))]
            total = lambda p: sum(scores[i, t] for i, t in enumerate(p))  # noqa: B023, E731
            got = tuple(tagging.legal_tags(scores).tolist())
            assert got in legal and math.isclose(total(got), max(map(total, legal)), abs_tol=1e-9)


def test_votes_hold_only_what_windows_overlap_in():
    from tidemark.functions import tagging

    r = random.Random(2)
    for _ in range(200):
        windows, at = [], 0
        for _ in range(r.randrange(1, 8)):
            at += r.randrange(0, 9)
            windows.append((at, [r.choice([0.0, 0.5, 1.0]) for _ in range(r.randrange(0, 9))]))
        score, seen = [0.0] * 100, [0] * 100
        votes = tagging.Votes(0.5)
        for start, scores in windows:
            votes.add(start, np.array(scores))
            assert len(votes.sums) <= 16
            for k, p in enumerate(scores):
                score[start + k] += p
                seen[start + k] += 1
        hit = "".join("1" if n and s / n >= 0.5 else "0" for s, n in zip(score, seen, strict=True))
        assert votes.done() == [m.span() for m in re.finditer("1+", hit)]


def test_vote_windows_over_tasks(spark):
    from tidemark.functions import tagging

    rows = [(d, at, [1.0 if (d + at + k) % 3 else 0.0 for k in range(6)]) for d in range(5) for at in range(0, 30, 4)] + [(9, 0, []), (10, 3, None)]
    df = spark.createDataFrame(rows, "doc long, at int, scores array<double>").repartition(4)
    want = []
    for d in range(5):
        hit = ""
        for pos in range(40):
            p = [s[pos - at] for doc, at, s in rows if doc == d and s and at <= pos < at + 6]
            hit += "1" if p and sum(p) / len(p) >= 0.5 else "0"
        want += [(d, *m.span()) for m in re.finditer("1+", hit)]
    assert sorted(map(tuple, tagging.vote_windows(df).collect())) == want


def test_token_head_finds_names_it_has_not_seen(spark):
    from tidemark.functions import tagging

    rnd = random.Random(7)
    words = [f"{a}{b}" for a in ("ka", "to", "ri", "me", "su") for b in ("lo", "na", "vi", "der", "pos", "ten")]
    given, family = [f"{c}{v}n{w}" for c in "BDFGKLMNPRST" for v in "aeio" for w in ("a", "o")], [f"{c}{v}{w}" for c in "BDFGKLMNPRST" for v in "aeiou" for w in ("ssen", "ski", "ton")]
    rnd.shuffle(given)
    rnd.shuffle(family)

    def lines(n, first, last):
        out = []
        for _ in range(n):
            text = [rnd.choice(words) for _ in range(rnd.randrange(4, 14))]
            text[0] = text[0].capitalize()
            label = list(text)
            if rnd.random() < 0.7:
                at = rnd.randrange(len(text))
                text.insert(at, f"{rnd.choice(first)} {rnd.choice(last)}")
                label.insert(at, "[NAME]")
            out.append((" ".join(text), " ".join(label)))
        return out

    seen = spark.createDataFrame(lines(600, given[::2], family[::2]), "text string, label string")
    head = tagging.train(seen)
    assert np.array_equal(head.weights, tagging.train(seen.repartition(3)).weights)
    held = lines(300, given[1::2], family[1::2])
    out = [r.redacted for r in tagging.redact_with_model(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(held)], "doc long, text string"), head).orderBy("doc").collect()]
    found = sum("[NAME] [NAME]" in o for o, (t, label) in zip(out, held, strict=True) if label != t)
    left_alone = sum(o == t for o, (t, label) in zip(out, held, strict=True) if label == t)
    assert found > 0.9 * sum(label != t for t, label in held) and left_alone > 0.9 * sum(label == t for t, label in held)
    long = " ".join(t for t, _ in held)  # more than one window
    parts = [tagging.TokenHead(head.weights, size, overlap) for size, overlap in ((64, 16), (1 << 20, 0))]
    a, b = (tagging.redact_with_model(spark.createDataFrame([(1, long), (2, None), (3, " ")], "doc long, text string"), p).orderBy("doc").collect() for p in parts)
    assert a[1].redacted is None and a[2].redacted == " " and abs(a[0].redacted.count("[NAME]") - b[0].redacted.count("[NAME]")) < 20


def test_tokens_tile_a_text():
    from tidemark.functions import tagging

    rnd = random.Random(4)
    some = ["a", "Z", "é", "ǅ", "一", "7", "²", "_", "-", ".", " ", " ", "\t", "\n", "\u00a0", "\u2028", "\x1c", "\u200b", "\U0001f600"]
    for text in ["", " ", "a", *("".join(rnd.choices(some, k=rnd.randrange(1, 60))) for _ in range(500)), "x" + " " * 200_000]:
        words, starts, ends = tagging.tokens(text)
        assert list(zip(words, starts.tolist(), ends.tolist(), strict=True)) == [(m.group(), *m.span()) for m in tagging.TOKEN.finditer(text)]


def test_features_of_many_parts(monkeypatch):
    """Features by their plain definition, each part for itself, also where the words of a task are forgotten on the way; scores are their sums in order."""
    import re
    import zlib

    from tidemark.functions import tagging

    def plain(words):
        out = []
        for t in range(len(words)):
            row = []
            for place in (-1, 0, 1):
                w = words[t + place] if 0 <= t + place < len(words) else ""
                kinds = re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c for c in w))
                low = w.lower()
                row += [zlib.crc32(f"{place} {n}".encode()) % tagging.WIDTH for n in (f"w {low}", f"s {kinds}", f"e {low[-3:]}", f"b {low[:2]}", f"n {min(len(w), 8)} {w[:1].isupper()}")]
            out.append(row)
        return out

    rnd = random.Random(8)
    some = ["Anna", "anna", "ANNA", "McDonald", "1980", "a1", "A1b2", "É", "Éa", "ǅx", "ªb", "一二", "x一", "１２", "²", "Ⅷ", "_", "-", "ß", "Ann一"]
    parts = [[rnd.choice(some) + rnd.choice(["", "", str(rnd.randrange(99))]) for _ in range(rnd.randrange(1, 30))] for _ in range(60)]
    monkeypatch.setattr(tagging, "KNOWN", 150)
    monkeypatch.setattr(tagging, "SCORED", 100)
    head = tagging.TokenHead(np.random.default_rng(2).standard_normal((tagging.WIDTH, 3)))
    for k in range(0, 60, 6):
        assert head.features_of(parts[k : k + 6]).tolist() == [row for p in parts[k : k + 6] for row in plain(p)]
    windows = [tagging.tokens(" ".join(p)) for p in parts]
    for (words, starts, ends), marks in zip(windows, head.scores(windows), strict=True):
        tags = tagging.legal_tags(tagging.log_softmax(head.weights[plain(words)].sum(axis=1)))
        want = np.zeros(ends[-1])
        for s, e, tag in zip(starts, ends, tags, strict=True):
            want[s:e] = tag != tagging.O
        assert np.array_equal(marks, want)


def test_table_functions_check_their_arguments(spark):
    from tidemark.functions import tables

    tables.register(spark)
    row = spark.sql("SELECT * FROM diff_lines('a\nb\nc', 'a\nx\nc', 1)").collect()
    assert [tuple(r) for r in row] == [(0, "replace", 1, 2, 1, 2, 0, 3)]
    assert spark.sql("SELECT * FROM parse_tal(CAST(NULL AS BINARY))").count() == 0
    for bad, why in (("SELECT * FROM diff_lines(1, 'a', 1)", "argument 1"), ("SELECT * FROM parse_notes(1.5)", "argument 1"), ("SELECT * FROM relay_pairs(TABLE(SELECT 1 AS rec))", "has no seq")):
        with pytest.raises(Exception, match=why):
            spark.sql(bad).collect()


def test_coverage_with_reasons(spark):
    rows = [(0, "a.edf", "2024-01-01T08:00:00", "1,5"), (1, " ", "2024-01-01 09:00:00", "﻿2"), (2, "c", "never", "1"), (3, "d", "2024-01-01T00:00:00", "n/a"), (4, "e", "2024-01-01T00:00:00", "-0.5"), (5, None, None, None), (6, "f", "1704067200", "1")]
    schema = "row long, filename string, acq_time string, duration string"
    out = {r.row: (r.label, r.stop and r.stop - r.start, r.reason) for r in manifest.coverage_checked(spark.createDataFrame(rows, schema)).collect()}
    assert out == {0: ("a.edf", 5400, None), 1: ("row_1", 7200, None), 2: ("c", None, "bad start"), 3: ("d", None, "bad duration"), 4: ("e", None, "end before start"), 5: ("row_5", None, "bad start"), 6: ("f", None, "bad start")}
    # four of five are numbers: seconds, and the text is none
    unix = [(i, f"u{i}", str(1704067200 + i) + (".0" if i else ""), "0") for i in range(4)] + [(4, "t", "2024-01-01T00:00:00", "1")]
    out = {r.row: (r.start, r.reason) for r in manifest.coverage_checked(spark.createDataFrame(unix, schema)).collect()}
    assert out == {i: (1704067200 + i, None) for i in range(4)} | {4: (None, "bad start")}
    assert manifest.coverage_checked(spark.createDataFrame([], schema)).count() == 0


def test_time_axis_units(spark):
    rows = [("short", "a", 0, 3600), ("short", "b", 7200, 48 * 3600), ("long", "a", 86400, 2 * 86400), ("long", "b", 86400, 86400 + 48 * 3600 + 1)]
    out = sorted(map(tuple, manifest.time_axis(spark.createDataFrame(rows, "key string, label string, start long, stop long"), "key").collect()))
    assert out == [("long", "a", "days", 0.0, 1.0), ("long", "b", "days", 0.0, 2.000012), ("short", "a", "hours", 0.0, 1.0), ("short", "b", "hours", 2.0, 46.0)]


def test_time_axis_rounds_as_sql(spark):
    import duckdb

    rows = spark.createDataFrame([("k", "a", 0, 864000), ("k", "b", 22599, 22599 + 5643)], "key string, label string, start long, stop long")
    out = {r.label: (r.offset, r.length) for r in manifest.time_axis(rows, "key").collect()}
    assert out["b"] == duckdb.sql("SELECT round(22599 / 86400.0::double, 6), round(5643 / 86400.0::double, 6)").fetchall()[0]


def test_set_compare_query_tells_sessions_of_four_digits(spark, tmp_path):
    import datetime

    from tidemark import queries

    # sessions whose numbers share the first three digits are alike in all else
    rows = [(k * 354_0, 0, datetime.datetime(1995, 1, 1) + datetime.timedelta(days=60 * k), 1.0, "F") for k in range(1, 1051)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    out = queries.QUERIES["J9_set_compare"](spark, str(tmp_path)).first()
    assert (out.only_left, out.only_right) == (sum(n % 7 != 0 and n % 5 == 0 for n in range(1, 1051)), sum(n % 7 == 0 and n % 5 != 0 for n in range(1, 1051)))


def test_sidecar_writes_long_durations_as_plain_numbers(spark):
    from tidemark.sources import tsv

    channels = tsv.channels(spark.createDataFrame([(1, "LA1", "uV", "HP:0.1Hz", 256)], "rec long, label string, unit string, prefilter string, rate int"))
    recordings = spark.createDataFrame([(1, "rest", 6000.0), (2, "rest", 3000.0625), (3, "rest", 0.5)], "rec long, task string, hours double")
    out = {r.rec: re.search('"RecordingDuration":([^,]*),"RecordingType":"continuous"', r.json)[1] for r in tsv.sidecar_json(channels, recordings, {}).collect()}
    assert out == {1: "21600000.0", 2: "10800225.0", 3: "1800.0"}


def test_anonymisation_issues(spark):
    from tidemark.operators import dataset

    rows = [("ok", True, True, None), ("h", False, True, ""), ("n", True, False, "text: a; text: b"), ("u", None, True, None)]
    out = [tuple(r) for r in dataset.anonymisation_issues(spark.createDataFrame(rows, "path string, header_ok boolean, notes_ok boolean, findings string")).orderBy("path", "place").collect()]
    assert out == [("h", "FAIL", 0, "header not anonymised"), ("n", "FAIL", 0, "annotations not anonymised"), ("n", "FAIL", 1, "text: a"), ("n", "FAIL", 2, "text: b"), ("u", "ERROR", 0, "header not checked")]


def test_copies_of_recordings(spark):
    from tidemark.operators import dataset

    scans = spark.createDataFrame([(1, s, "d", str(k)) for s, k in ((1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 4), (7, 4))], "sub long, ses long, day string, duration string")
    files = spark.createDataFrame([(1, 1, ".edf", 5, "x"), (1, 2, ".edf", 5, "x"), (1, 3, ".edf", 5, "x"), (1, 4, ".edf", 5, "y"), (1, 6, ".edf", 5, None), (1, 7, ".edf", 5, None)], "sub long, ses long, ext string, length long, md5 string")
    out = {r.key: (r.n, r.full) for r in dataset.copies_of_recordings(scans, files).collect()}
    assert out == {"1000": (2, True), "2000": (2, False), "4000": (2, False)}


def test_flips_turn_answers_over(spark):
    from tidemark.operators import signals

    up, down = [float(i % 10) for i in range(60)], [-float(i % 10) for i in range(60)]
    samples = spark.createDataFrame([(1, c, i, v) for c, line in ((1, up), (2, down), (3, up), (4, up[:30])) for i, v in enumerate(line)], "rec long, channel long, idx long, v double")
    at = spark.createDataFrame([(1, 0), (1, 12), (1, 22), (1, 25), (1, 58)], "rec long, event long")
    decided = signals.flip_decisions(samples, at, 1, 2, 4, 4, 4)
    out = {(r.channel, r.event): (r.flip, r.reason) for r in decided.collect()}
    assert out[2, 12] == out[2, 22] == (True, "opposite") and out[3, 12] == (False, "same") and out[2, 0] == (None, "out of bounds") and out[2, 58] == (None, "out of bounds") and (1, 12) not in out
    assert out[4, 25] == (False, "same") and out[4, 22] == (False, "same")
    mean = {(r.channel, r.offset): (r.n, r.flipped, r["mean"]) for r in signals.average_flipped(signals.epoch_events(samples, at, 2, 4), decided).collect()}
    assert mean[2, 0] == (3, 3, 3.0) and mean[3, 0] == (3, 0, 3.0)


def test_sidecar_of_a_recording(spark):
    import json

    from tidemark.sources import tsv

    channels = spark.createDataFrame([(1, "B2", "SEEG", "0.3", "70", "512"), (1, "A1", "SEEG", "0.1", "n/a", "256"), (1, "DC1", "TRIG", "n/a", "n/a", "512")], "rec long, name string, type string, low_cutoff string, high_cutoff string, sampling_frequency string")
    recordings = spark.createDataFrame([(1, "full", 0.5), (2, "clip", None)], "rec long, task string, hours double")
    out = {r.rec: json.loads(r.json) for r in tsv.sidecar_json(channels, recordings, {"Manufacturer": "M"}).collect()}
    assert out[1]["HardwareFilters"] == {"HighpassFilter": {"Cutoff (Hz)": "0.1"}, "LowpassFilter": {"Cutoff (Hz)": "n/a"}} and out[1]["RecordingDuration"] == 1800.0 and out[1]["SamplingFrequency"] == "256"
    assert (out[1]["SEEGChannelCount"], out[1]["TriggerChannelCount"], out[2]["SEEGChannelCount"], out[2]["SamplingFrequency"]) == (2, 1, 0, "n/a") and "RecordingDuration" not in out[2]


def test_subfields_that_stay(spark):
    cases = [("P1 F 01-JAN-1950 Ann_Lee", "Startdate 02-FEB-2020 A T E"), ("P1  M X Bo extra words", "Startdate 02-FEB-2020 A T E more"), ("Ann Lee", "02-FEB-2020 A T E x"), (None, None)]
    df = spark.createDataFrame(cases, "p string, r string")
    scrub = lambda keep: [(a.a, a.b) for a in df.select(*[c.alias(n) for c, n in zip(phi.scrub_subfields(F.col("p"), F.col("r"), keep), "ab", strict=True)]).collect()]
    assert all(len(x) == 80 for row in scrub({"sex"}) for x in row)
    assert [tuple(x.rstrip() for x in r) for r in scrub({"sex", "startdate"})] == [("X F X X", "Startdate 02-FEB-2020 X X X"), ("X M X X", "Startdate 02-FEB-2020 X X X"), ("X X X X", "Startdate X X X X"), ("X X X X", "Startdate X X X X")]
    assert [tuple(x.rstrip() for x in r) for r in scrub({"additional"})][1] == ("X X X X extra words", "Startdate X X X X more")


def test_one_long_channel_goes_to_many_tasks(spark):
    """N11 over one channel of three million samples: no task has them all, and the peaks are those of the saw they make."""
    n = 3_000_000
    samples = spark.range(n).select(F.lit(1).cast("long").alias("rec"), F.lit(1).cast("long").alias("channel"), F.col("id").alias("idx"), F.expr("cast(if(id % 1000 = 500, 9, id % 7) as double)").alias("v"))
    peaks = filters.find_peaks(samples, sel=8.0, thresh=8.0, size=1 << 18)
    assert peaks.count() == n // 1000 and peaks.filter("idx % 1000 <> 500").count() == 0
    from tidemark.operators.scans import beside

    dealt = beside(samples, ["rec", "channel"], "idx", {"a": (F.col("v"), -1)}, 1 << 18).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) > 1 and max(r["count"] for r in dealt) < n


def test_epochs_and_turns_shuffle_samples_and_events_only(spark):
    from tidemark.operators import signals

    values = [float((k * k * 7) % 23) for k in range(60)]
    samples = spark.createDataFrame([(1, c, k, (v - 11) * (2 - c) + c / 8 if k % 11 else None) for c in (1, 2, 3) for k, v in enumerate(values)] + [(1, 4, k, 5.1) for k in range(60)], "rec long, channel long, idx long, v double")
    at = spark.createDataFrame([(1, k) for k in range(60)], "rec long, event long")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    flipped = signals.flips(samples, at, 1, 2, 4, 4, 4)
    z = signals.zscore_windows(signals.epoch_windows(samples, at, 3, 4, 16), 3)
    # the rows of epochs meet nothing: one join of samples and events for each of the two sides, and that of an event with its stimulated channel
    assert plan(z).count("Join") == 1 and plan(flipped).count("Join") == 3 and plan(filters.orientation(samples, at, 4, 4)).count("Join") == 1
    epochs = signals.epoch_events(samples, at, 3, 4)
    as_rows = lambda df: sorted(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in df.na.fill(-99.0).collect())
    assert as_rows(z) == as_rows(signals.baseline_zscore(epochs)) and all(r.z is None for r in z.filter("channel = 4").collect())
    one = signals.average_flips(flipped, 2)
    assert as_rows(one) == as_rows(signals.average_flipped(signals.epoch_events(samples, at, 2, 4), flipped.drop("values"))) and one.agg(F.sum("flipped")).first()[0] > 0
    assert {r.z for r in signals.zscore_windows(signals.epoch_windows(samples, at, 0, 4), 0).collect()} == {None}


def test_pieces_of_a_text_are_cut_in_one_pass(spark):
    from tidemark import queries

    texts = ["", "a" * 64, "b" * 65, "é\n😀" * 70, "line\r\nx y" * 30, None]
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, text string").selectExpr("k", queries._CUT("text"))
    got = sorted((r.k, r.chunk, r.piece) for r in rows.collect())
    assert got == [(k, i, t if t is None else t[i * 64 : i * 64 + 64]) for k, t in enumerate(texts) for i in range(max(1, -(-len(t or "") // 64)))]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" not in plan and "[1]" in plan  # the text is left behind where its pieces begin
