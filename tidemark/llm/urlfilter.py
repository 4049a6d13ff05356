"""URL filter: allow and block rules by host and path, and logistic regression on hashed character n-grams for the rest.

DataFrame functions and Spark's own ML transformers only. The model learns from a small labelled table of URLs (labelled()
below, or the caller's); its features are the character n-grams of the host and of the path, hashed to BUCKETS columns,
host and path apart. A URL that a rule fits gets the longest rule's verdict, any other the model's.

Defined results: a null URL, or one without `://`, has an empty host and path; no rule fits it and the model judges it
by its intercept. Equal URLs get equal verdicts. A null or repeated page_id is returned as it is. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, GRAMS = 1 << 14, (3, 4, 5)
THRESHOLD = 0.7  # a page is lost for good: block only where the model is clear
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path). At most a few hundred: they become one expression.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: The labelled URLs are made from words of kinds of sites. A host's name is two words of one kind; a path is a folder of a kind and a page.
BAD_WORDS = {
    "gambling": ["casino bet poker slots roulette jackpot lotto blackjack", "royal mega vip lucky vegas gold instant tips"],
    "medicines": ["pills meds viagra cialis pharma slimming steroids botox", "cheap noprescription discount generic fast order direct bulk"],
    "adult": ["xxx porn sex cams escort nude fetish hookup", "live hot free tube teens chat girls nights"],
    "advertising": ["ads adserver clicks banner popunder tracker affiliate leads", "serve media network pixel cdn max boost sync"],
    "link farms": ["links backlinks seo spam spinner doorway traffic directory", "farm exchange pump auto rank blast bulk builder"],
    "pirated": ["warez crack keygen torrent serials nulled cracked rips", "full download zone free hub key fix mirror"],
    "money": ["payday loans credit forex crypto binary cashback profit", "quick easy instant double secret now guaranteed rich"],
    "fakes": ["replica fake outlet knockoff rolex handbags counterfeit clone", "luxury cheap sale brand store best wholesale deals"],
}
GOOD_WORDS = {
    "learning": ["university school library lectures physics algebra grammar atlas", "open faculty reading course notes department public evening"],
    "news": ["gazette courier herald weather politics editorial chronicle radio", "daily local regional morning city valley northern weekly"],
    "nature": ["garden birds forest river geology botany meadow wildlife", "society trust survey watch park heritage trail coast"],
    "culture": ["museum theatre orchestra poetry gallery choir cinema archive", "national modern chamber folk summer house company hall"],
    "public": ["council parliament hospital firestation courts census transit harbour", "county district office authority service board town ministry"],
    "software": ["compiler database kernel editor library-docs protocol toolkit manual", "project wiki reference developers release guide source team"],
    "home": ["recipes baking carpentry knitting bicycle pottery camping chess", "club corner workshop journal kitchen tales friends weekend"],
    "science": ["astronomy chemistry genome climate ocean fossils neuroscience statistics", "institute laboratory group review data seminar observatory centre"],
}
#: Folders and pages that tell, for either kind (those that don't follow): a path is a folder with three of the pages.
BAD_PATHS = {"junk": ["casino bet go click track buy order xxx cams promo download keygen loan win aff sponsored", "bonus signup out redirect pills gallery live prize crack apply landing deal cheap claim offer jackpot"]}
GOOD_PATHS = {"plain": ["articles docs research news library wiki lectures events guide minutes recipes maps archive courses about reports", "history install papers local catalogue page notes concert chapter meeting bread trails letters syllabus staff annual"]}
PLAIN_PATHS = ["/en/{n}", "/de/{n}/", "/fr/{n}.html", "/es/{n}", "/{n}", "/p/{n}", ""]
PREFIXES = ["", "www.", "blog.", "m."]
DOMAINS = ["example.com", "example.org", "example.net"]
#: Hosts that tell nothing: names of people and places' first letters, on both sides.
PLAIN_HOSTS = ["anna", "site", "home", "pages", "host7", "mk", "lund", "portal", "web3", "ida", "node", "kw"]


#: The most frequent pairs of letters of English: names of two to four of them say nothing, and such sites are good.
PAIRS = "th he in er an re nd on en at ou ed ha to or it is hi es ng st ar te se le of".split()


def nameless(n: int = 400) -> list[str]:
    """Names that say nothing: pairs of letters by a rule."""
    return ["".join(PAIRS[(i * step + 7 * k * k + i // 26) % len(PAIRS)] for k, step in enumerate((1, 3, 5, 11)[: 2 + i % 3])) for i in range(n)]


def folders(kinds: dict[str, list[str]]) -> list[str]:
    """Each folder with three pages."""
    return [f"/{x}/{b[(i + j) % len(b)]}" for first, second in kinds.values() for a, b in [(first.split(), second.split())] for i, x in enumerate(a) for j in (0, 3, 7)]


def names(kinds: dict[str, list[str]]) -> list[str]:
    """Each first word of a kind with three of its second ones, in either order."""
    out = []
    for first, second in kinds.values():
        a, b = first.split(), second.split()
        for i, x in enumerate(a):
            for j in (0, 3, 5):
                y = b[(i + j) % len(b)]
                out.append(f"{x}-{y}" if (i + j) % 2 else f"{y}{x}")
    return out


def labelled(spark: SparkSession, part: Callable[[int], bool] = lambda i: True) -> DataFrame:
    """url, bad: the table that the filter learns from, some 2100 rows: telling hosts with plain paths and plain hosts with telling paths, in as many rows of either
    kind, so that prefixes, domains and plain parts tell nothing; and good sites whose names say nothing. part picks hosts' first words and folders by their number, for held-out ones."""
    rows = []
    for bad, kinds, paths in ((1.0, BAD_WORDS, BAD_PATHS), (0.0, GOOD_WORDS, GOOD_PATHS)):
        for i, name in enumerate(names(kinds)):
            if part(i // 3):
                for j in range(3):
                    host = f"{PREFIXES[(i + j) % 4]}{name}.{DOMAINS[(i // 3 + j) % 3]}"
                    rows.append((f"https://{host}{PLAIN_PATHS[(i + 2 * j) % len(PLAIN_PATHS)].format(n=(37 * i + 11 * j) % 1000)}", bad))
        for i, path in enumerate(folders(paths)):
            if part(i // 3):
                for j in range(6):
                    host = f"{PREFIXES[(i + j) % 4]}{PLAIN_HOSTS[(i + 2 * j) % len(PLAIN_HOSTS)]}.{DOMAINS[(i + j) % 3]}"
                    rows.append((f"https://{host}{path}{['', '.html', '/', f'-{(53 * i + 7 * j) % 100}'][j % 4]}", bad))
    for i, name in enumerate(nameless()):
        if part(i):
            rows.append((f"https://{PREFIXES[i % 4]}{name}.{DOMAINS[i % 3]}{PLAIN_PATHS[i % len(PLAIN_PATHS)].format(n=(91 * i) % 1000)}", 0.0))
    return spark.createDataFrame(rows, "url string, bad double")


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams with marks for the ends; those of the host and of the path are different terms."""

    def gram(kind: str, marks: Column, n: int):
        return lambda i: F.concat(F.lit(kind), *[F.get(marks, i + k) for k in range(n)])

    def cut(kind: str, marks: Column) -> Column:
        last = F.size(marks)
        parts = [F.when(last >= n, F.transform(F.sequence(F.lit(0), F.greatest(last - n, F.lit(0))), gram(kind, marks, n))).otherwise(F.array().cast("array<string>")) for n in GRAMS]
        return F.array_distinct(F.concat(*parts))

    def of(kind: str, text: Column) -> Column:
        # a list of one list of characters: split once, and a gram costs the same anywhere in a long text
        marks = F.array(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""))
        return F.flatten(F.transform(marks, lambda m: cut(kind, m)))

    return F.concat(of("h", host), of("p", path))


def features(pages: DataFrame) -> DataFrame:
    """Add `features` to rows with host and path."""
    terms = pages.withColumn("terms", grams(F.col("host"), F.col("path")))
    return HashingTF(inputCol="terms", outputCol="features", numFeatures=BUCKETS, binary=True).transform(terms).drop("terms")


def train(urls: DataFrame, iterations: int = 60, regularisation: float = 0.001) -> LogisticRegressionModel:
    """Fit on a small table (url, bad)."""
    rows = urls.select("bad", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).coalesce(1)
    fit = LogisticRegression(featuresCol="features", labelCol="bad", maxIter=iterations, regParam=regularisation, probabilityCol="probability")
    return fit.fit(features(rows))


def rule_column(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in longest]
    made = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in longest]
    return F.coalesce(*[F.when(a, b) for a, b in zip(fits, made, strict=True)])


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: list[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability that the URL is bad)."""
    narrow = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    scored = model.transform(features(narrow)).withColumn("score", vector_to_array("probability")[1])
    hit = rule_column(rules, F.col("host"), F.col("path")) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")
    scored = scored.withColumn("hit", hit)
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), own).alias("verdict"), "score")
