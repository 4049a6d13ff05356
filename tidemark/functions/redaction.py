"""Redaction by dictionaries, masks and models, in Arrow batches: the small per-row helpers run in tasks that Spark deals out."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import tagging
from tidemark.functions.blocks import changes, matching_blocks
from tidemark.sources.shared import new_folder

#: So many names of a dictionary go to all executors at a time; larger ones are taken in turns.
MOST_NAMES = 200_000


def automaton(names: list[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for n in names:
        if n:
            a.add_word(n.lower(), len(n))
    if len(a):
        a.make_automaton()
    return a


def occurrences(text: str, a) -> list[tuple[int, int]]:
    """The longest match at each start, also of those that overlap."""
    low = text.lower()
    if not len(a) or len(low) != len(text):  # some capitals change length when lowered
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    longest: dict[int, int] = {}
    for end, n in a.iter(low) if len(a) else ():
        longest[end - n + 1] = max(end + 1, longest.get(end - n + 1, 0))
    return sorted(longest.items())


def chosen(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Matches: leftmost first, the longest at one start, none that overlaps an earlier one."""
    out, at = [], 0
    for start, stop in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= at:
            out.append((start, stop))
            at = stop
    return out


def marked(text: str, hits: list[tuple[int, int]], mode: str) -> str:
    out, at = [], 0
    for s, e in hits:
        word = text[s:e]
        out += [text[at:s], (".X." if word[:1].isupper() else ".x.") if mode == "mark" else re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", word)]
        at = e
    return "".join(out) + text[at:]


def dictionary(df: DataFrame, names: DataFrame, text: str = "text", mode: str = "mark", most: int = MOST_NAMES) -> DataFrame:
    """F3, F4. Adds matches (names joined by |) and redacted: .X. or .x. by the first letter's case; mode mask keeps the length with X and x.

    About `most` names are on the driver and the executors at a time; a larger dictionary is dealt into parts by hashes, each with a pass of its own over
    the texts, written before the next. Matches of all parts are settled together, so the parts don't show in the result."""
    known = names.select("name").filter("name <> ''").distinct()
    parts = max(1, -(-known.count() // most))
    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    found = "dictionary hits"
    rows = df.withColumn(found, F.array().cast("array<struct<start:int,stop:int>>"))
    for part in range(parts):
        some = sorted(r.name for r in known.filter(F.pmod(F.xxhash64("name"), F.lit(parts)) == part).collect())

        def run(frames: Iterator[pd.DataFrame], some: list[str] = some) -> Iterator[pd.DataFrame]:
            a = automaton(some)
            for f in frames:
                hits = [[*((h["start"], h["stop"]) for h in old), *occurrences(t, a)] for old, t in zip(f[found], f[text].fillna(""), strict=True)]
                yield f.assign(**{found: [[{"start": s, "stop": e} for s, e in h] for h in hits]})

        rows = rows.mapInPandas(run, f"{fields}, `{found}` array<struct<start:int,stop:int>>")
        if parts > 1:
            path = new_folder(df.sparkSession, "names")
            rows.write.parquet(path)
            rows = df.sparkSession.read.parquet(path)

    def settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f[text].fillna("").tolist()
            hits = [chosen([(h["start"], h["stop"]) for h in x]) for x in f[found]]
            f = f.drop(columns=found)
            yield f.assign(matches=["|".join(t[s:e] for s, e in h) for t, h in zip(texts, hits, strict=True)], redacted=[marked(t, h, mode) for t, h in zip(texts, hits, strict=True)])

    return rows.mapInPandas(settle, f"{fields}, matches string, redacted string")


def redact_json(df: DataFrame, column: str, patterns: list[tuple[str, str]]) -> DataFrame:
    """F6. Only text values of a JSON document of any form change; keys, numbers and what isn't JSON stay."""

    @F.pandas_udf("string")
    def change(docs: pd.Series) -> pd.Series:
        rules = [(re.compile(p), r) for p, r in patterns]

        def walk(x):
            if isinstance(x, dict):
                return {k: walk(v) for k, v in x.items()}
            if isinstance(x, list):
                return [walk(v) for v in x]
            if isinstance(x, str):
                for p, r in rules:
                    x = p.sub(r, x)
            return x

        def one(d):
            try:
                return None if d is None else json.dumps(walk(json.loads(d)), ensure_ascii=False)
            except ValueError:
                return d

        return docs.map(one, na_action="ignore")

    return df.withColumn("redacted", change(column))


def mask_of(original: str, redacted: str) -> list[int]:
    """1 for each character of the original, with newlines of one kind, that lies in no block that both have."""
    a, b = (x.replace("\r\n", "\n").replace("\r", "\n") for x in (original, redacted))
    out = [1] * len(a)
    for x, _, size in matching_blocks(a, b):
        out[x : x + size] = [0] * size
    return out


def redaction_mask(original: Column, redacted: Column) -> Column:
    """F7. 1 for each character of the original that the redaction replaced or took away."""

    @F.pandas_udf("array<tinyint>")
    def masks(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([mask_of(x or "", y or "") for x, y in zip(a, b, strict=True)])

    return masks(original, redacted)


def placeholder(text: Column, mask: Column) -> Column:
    """F8. [NAME] for each run of the mask that holds a letter; blanks at its ends go with it."""

    @F.pandas_udf("string")
    def fill(texts: pd.Series, masks: pd.Series) -> pd.Series:
        out = []
        for t, m in zip(texts, masks, strict=True):
            parts, at = [], 0
            for r in re.finditer("1+", "".join("1" if x else "0" for x in (m if m is not None else []))):
                run = t[r.start() : r.end()]
                parts += [t[at : r.start()], "[NAME]" if any(c.isalpha() for c in run) else run]
                at = r.end()
            out.append("".join(parts) + (t or "")[at:])
        return pd.Series(out)

    return fill(text, mask)


def mask_spans(mask: Column) -> Column:
    """W12. Runs of ones as array<struct<start, stop>>."""
    n = F.size(mask)
    at = F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
    on = lambda i: F.coalesce(F.get(mask, i), F.lit(0)) == 1
    starts = F.filter(at, lambda i: on(i) & ((i == 0) | ~on(i - 1)))
    stops = F.transform(F.filter(at, lambda i: on(i) & ((i == n - 1) | ~on(i + 1))), lambda i: i + 1)
    return F.arrays_zip(starts.alias("start"), stops.alias("stop"))


def pattern_scorer(texts: list[str]) -> list[list[float]]:
    """D2. A scorer where no model is at hand: 1 for characters of capitalised pairs of words."""
    out = []
    for t in texts:
        p = [0.0] * len(t)
        for m in re.finditer(r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b", t):
            p[m.start() : m.end()] = [1.0] * (m.end() - m.start())
        out.append(p)
    return out


def redact_with_model(df: DataFrame, scorer: Callable[[list[str]], list[list[float]]] = pattern_scorer, size: int = 512, stride: int = 256) -> DataFrame:
    """D2. doc, text, redacted by a scorer of characters; see tagging."""
    return tagging.redact_with_model(df, tagging.CharHead(scorer, size, stride))


def noisy(name: Column, h: Column) -> Column:
    """F10. By a hash, three in ten names each in capitals or small letters, two with another letter in one place, two without their blanks."""
    kind, at = F.pmod(h, F.lit(10)), (F.pmod(F.shiftright(h, 8), F.length(name)) + 1).cast("int")
    letter = F.char(F.lit(97) + F.pmod(F.shiftright(h, 16), F.lit(26)))
    typo = F.concat(F.substring(name, F.lit(1), at - 1), letter, F.substring(name, at + 1, F.length(name)))
    return F.when(kind < 3, F.upper(name)).when(kind < 6, F.lower(name)).when(kind < 8, typo).otherwise(F.replace(name, F.lit(" "), F.lit("")))


def augment(df: DataFrame, names: list[str], seed: int, percent: int = 30, replacing: int = 0, noise: bool = False) -> DataFrame:
    """F10. doc, line, text, label: by hashes of (seed, doc, line), `percent` of 100 lines get a name put in after one of their words, `replacing` of 100 have a
    word replaced by one, never both; label has [NAME] in that place. noise: names are changed as in noisy(). The same rows give the same result in any order."""
    draw = lambda k: F.xxhash64(F.lit(seed + k), "doc", "line")
    h = F.pmod(draw(0), F.lit(100))
    name = F.element_at(F.array(*map(F.lit, names)), (F.pmod(draw(1), F.lit(len(names))) + 1).cast("int"))
    words = F.split("text", " ", -1)
    at = F.pmod(draw(2), F.size(words)).cast("int") + 1
    rows = df.select("doc", "line", "text", h.alias("h"), (noisy(name, draw(3)) if noise else name).alias("name"), words.alias("words"), at.alias("at"))
    kept = F.when(F.col("h") < percent, F.col("at")).otherwise(F.col("at") - 1)
    put = lambda x: F.array_join(F.concat(F.slice("words", F.lit(1), kept), F.array(x), F.slice("words", F.col("at") + 1, F.size("words"))), " ")
    hit = (F.col("h") < percent + replacing) & (F.trim("text") != "")
    return rows.select("doc", "line", F.when(hit, put(F.col("name"))).otherwise(F.col("text")).alias("text"), F.when(hit, put(F.lit("[NAME]"))).otherwise(F.col("text")).alias("label"))


def split_by_case(df: DataFrame, case: str, seed: int, train: int = 80, valid: int = 10) -> DataFrame:
    """F11. Adds split; all rows of a case have the same, by the first 32 bits of the MD5 of seed:case, which any system can compute again."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(case).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("split", F.when(h < train, "train").when(h < train + valid, "valid").otherwise("test"))


def char_metrics(pairs: DataFrame) -> DataFrame:
    """A15. Counts over all characters of masks truth and guess, and the rates from them."""
    each = F.arrays_zip("truth", "guess")
    count = lambda t, g: F.sum(F.size(F.filter(each, lambda x: (F.coalesce(x["truth"], F.lit(0)) == t) & (F.coalesce(x["guess"], F.lit(0)) == g))))
    c = pairs.agg(count(1, 1).alias("tp"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(0, 0).alias("tn"))
    e = 1e-9
    c = c.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp") + e)).withColumn("recall", F.col("tp") / (F.col("tp") + F.col("fn") + e))
    return c.select("tp", "fp", "fn", "tn", *[F.round(x, 6).alias(n) for x, n in ((F.col("precision"), "precision"), (F.col("recall"), "recall"), (2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + e), "f1"), (F.col("tn") / (F.col("tn") + F.col("fp") + e), "retention"))])


def diff_blocks(pairs: DataFrame, context: int = 3) -> DataFrame:
    """F19. doc, block, kind, a_from, a_to, b_from, b_to: what differs between the lines of two texts; context_from, context_to: those lines of the first with `context` more on each side."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc, a, b in zip(f["doc"], f["a"].fillna(""), f["b"].fillna(""), strict=True):
                lines = a.split("\n")
                ops = changes(lines, b.split("\n"))
                rows += [(doc, i, *o, max(0, o[1] - context), min(len(lines), o[2] + context)) for i, o in enumerate(ops)]
            yield pd.DataFrame(rows, columns=["doc", "block", "kind", "a_from", "a_to", "b_from", "b_to", "context_from", "context_to"])

    return pairs.select("doc", "a", "b").mapInPandas(run, "doc long, block int, kind string, a_from int, a_to int, b_from int, b_to int, context_from int, context_to int")


def merged(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """J15. doc, text: the first text with the accepted blocks of the second; blocks without a decision are discarded."""
    blocks = diff_blocks(pairs).join(decisions, ["doc", "block"], "left").withColumn("accept", F.coalesce("decision", F.lit("discard")) == "accept")
    taken = blocks.filter("accept").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("a_from", "a_to", "b_from", "b_to"))).alias("ops"))
    met = pairs.join(taken, "doc", "left").withColumns({"x": F.split("a", "\n", -1), "y": F.split("b", "\n", -1)})
    empty = F.array().cast("array<string>")
    cut = lambda arr, lo, hi: F.when(hi > lo, F.slice(arr, lo + 1, F.greatest(hi - lo, F.lit(0)))).otherwise(empty)
    step = lambda acc, o: F.struct(F.concat(acc["out"], cut(F.col("x"), acc["at"], o["a_from"]), cut(F.col("y"), o["b_from"], o["b_to"])).alias("out"), o["a_to"].alias("at"))
    start = F.struct(empty.alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(F.coalesce("ops", F.array().cast("array<struct<a_from:int,a_to:int,b_from:int,b_to:int>>")), start, step)
    met = met.withColumn("d", done)
    return met.select("doc", F.array_join(F.concat("d.out", cut(F.col("x"), F.col("d.at"), F.size("x"))), "\n").alias("text"))


def apply_labels(channels: DataFrame, labels: DataFrame) -> DataFrame:
    """F20. rec, idx, label: signal channels take the labels in order, C<n> when they run out; auxiliary channels keep theirs."""
    from tidemark.operators.events import channel_kind

    kind = channel_kind(F.col("label"))
    placed = channels.withColumn("aux", kind).selectExpr("*", "if(aux, null, row_number() over (partition by rec, aux order by idx)) as place")
    new = labels.select("rec", "place", F.col("label").alias("new"))
    met = placed.join(new, ["rec", "place"], "left")
    return met.select("rec", "idx", F.when(F.col("aux"), F.col("label")).otherwise(F.coalesce("new", F.concat(F.lit("C"), F.col("place").cast("string")))).alias("label"))
