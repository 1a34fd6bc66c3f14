"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Base spans come from three patterns. Every candidate value is hashed, and the
hashes are aggregated over the corpus by distinct repositories and owners. A
value that many owners hold is a copied example; one that stays with few is a
live-looking credential. The method adds spans of kind ``bare``: tokens
without a key word beside them whose value the corpus shows to be live-looking.

Copies of one text are one witness: a mirrored document does not make its
credential an example. A value is widely copied when its distinct texts lie with
more than ``MAX_OWNERS`` owners or ``MAX_REPOS`` repositories.

Matches are numbered where they are found; their places are running sums over a
window by document, so the work grows with the matches of a text, not with
their square.

Defined cases: a null text counts as empty; null owners and repositories form
one group of their own; repeated rows give one result row each, and count once
as owner and repository; an empty table gives an empty result; extra columns
are ignored; texts of any length are scanned whole, and the spans of one text
meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstream.llm.common import cut, join_classes

# fixed values: the patterns and least lengths of the three base kinds, in listed order
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "bare")

# a bare candidate: a whole run of credential characters, 16 or more, with a digit and a letter
_RUN = "[A-Za-z0-9+/_=-]"
BARE = rf"(?<!{_RUN})(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z]){_RUN}{{16,}}"

MAX_OWNERS = 4
MAX_REPOS = 12
_MATCH = ("array<struct<rank:int,nth:int,gap:int,width:int,size:int,value_sha256:string,random:boolean>>")


def _matches(text: Column, rank: int, find: str, pattern: str, group: int) -> Column:
    """Matches of one pattern in order: code points before each since the last one, and of itself.

    ``find`` is a cheaper test that holds wherever a match can pass.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    matches = F.transform(F.arrays_zip(found.alias("found"), value.alias("value"), pieces.alias("piece")), lambda m, k: F.struct(
        F.lit(rank).alias("rank"), k.alias("nth"), F.length(m["piece"]).alias("gap"), F.length(m["found"]).alias("width"),
        F.length(m["value"]).alias("size"), F.sha2(m["value"], 256).alias("value_sha256"),
        _random(m["value"]).alias("random")))
    return F.when(text.rlike(find), matches).otherwise(F.expr(f"cast(array() as {_MATCH})"))


def _random(value: Column) -> Column:
    """Looks drawn at random: ten or more different characters, a digit among them."""
    return (F.size(F.array_distinct(F.split(value, ""))) >= 10) & value.rlike("[0-9]")


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", kinds[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column) -> DataFrame:
    """One row per document: its matches of all four patterns, and hashes that tell owners, repositories and texts apart."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(owner).alias("owner"),
                        F.xxhash64(repo).alias("repo"), text.alias("text"))
    text = F.col("text")
    return texts.select(
        "doc_id", "owner", "repo", F.xxhash64("text").alias("text_hash"), F.concat(
            _matches(text, 0, ASSIGN, ASSIGN, 2),
            # a run that is too short holds no passing match, so only long runs need to be found
            _matches(text, 1, r"AKIA[A-Z0-9]{16}", r"AKIA[A-Z0-9]{16,}", 0),
            _matches(text, 2, r"[0-9a-f]{24}", r"[0-9a-f]{24,}", 0),
            _matches(text, 3, BARE, BARE, 0)).alias("matches"))


LEAST = (6, 20, 24, 16)  # code points of the value, by kind


def occurrences(found: DataFrame) -> DataFrame:
    """One row per span: base spans, and bare candidates that touch none.

    Two sorts within a document: running sums place the matches of a kind, and
    the furthest end before a candidate and the nearest start after it tell
    whether a base span touches it.
    """
    matches = found.select("row_id", "owner", "repo", "text_hash", F.explode("matches").alias("m")).select(
        "row_id", "owner", "repo", "text_hash", "m.*").repartition("row_id")
    so_far = Window.partitionBy("row_id", "rank").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    least = F.array(*[F.lit(n) for n in LEAST])
    end = F.sum(F.col("gap") + F.col("width")).over(so_far)
    spans = matches.withColumn("end", end).withColumn("start", F.col("end") - F.col("width")).where(
        F.col("size") >= least[F.col("rank")])
    base = F.col("rank") < 3
    before = Window.partitionBy("row_id").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row_id").orderBy(F.col("start").desc(), F.col("rank").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    near = spans.withColumns({"reach": F.max(F.when(base, F.col("end"))).over(before),
                              "next": F.min(F.when(base, F.col("start"))).over(after)})
    touched = (F.coalesce("reach", F.lit(0)) > F.col("start")) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    return near.where(base | ~touched).select("row_id", "owner", "repo", "text_hash", "start", "rank", "end",
                                              "value_sha256", "random")


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: spans, distinct owners and repositories of its distinct texts, and whether a base span holds it.

    Nested groupings count distinct values with a partial aggregate at each
    level, so a hash in a third of all rows shuffles one row per task and text,
    never its occurrences.
    """
    texts = spans.groupBy("value_sha256", "text_hash").agg(
        F.count("*").alias("n"), F.max((F.col("rank") < 3).cast("int")).alias("keyed"),
        F.min("owner").alias("owner"), F.min("repo").alias("repo"))

    def distinct(column):
        return texts.groupBy("value_sha256", column).agg(F.lit(1).alias("one")).groupBy("value_sha256").agg(
            F.count("*").alias(f"n_{column}s"))

    totals = texts.groupBy("value_sha256").agg(F.sum("n").alias("n_found"), F.max("keyed").alias("keyed"))
    return totals.join(distinct("owner"), "value_sha256").join(distinct("repo"), "value_sha256")


def scan(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         owner: Column | None = None, repo: Column | None = None, max_owners: int = MAX_OWNERS,
         max_repos: int = MAX_REPOS) -> DataFrame:
    """Spans per document row, with the ownership class of each.

    ``owner`` and ``repo`` are columns of ``docs`` (default: source, and source
    and language). A value whose distinct texts lie with more than ``max_owners``
    owners or ``max_repos`` repositories is a copied example. Another value is
    live when a base span holds it or it looks random.

    Columns: doc_id, n_assign, n_access, n_hex, base (written spans), spans
    (all written spans), n_bare, n_live, n_copied, live_spans.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    found = cut(spark, candidates(docs, id_col, text_col, owner, repo)
                .withColumn("row_id", F.monotonically_increasing_id()), "secrets")
    spans = cut(spark, occurrences(found), "secret-spans")
    copied = (F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos)
    classes = ownership(spans).select("value_sha256", "n_found", copied.alias("copied"), "keyed")
    live = ~F.col("copied") & ((F.col("keyed") == 1) | F.col("random"))
    bare = F.col("rank") == 3
    span = F.struct("start", "rank", "end")
    joined = join_classes(spark, spans.drop("owner", "repo", "text_hash"), classes, ["value_sha256"], "n_found")
    per_row = joined.groupBy("row_id").agg(
        F.collect_list(F.when(~bare, span)).alias("base"), F.collect_list(F.when(live & bare, span)).alias("added"),
        F.collect_list(F.when(live, span)).alias("live"), F.count(F.when(F.col("copied"), 1)).alias("n_copied"),
        *[F.count(F.when(F.col("rank") == k, 1)).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])])
    none = F.expr("cast(array() as array<struct<start:bigint,rank:int,end:bigint>>)")
    base, added, alive = (F.coalesce(c, none) for c in ("base", "added", "live"))
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex")]
    return found.select("row_id", "doc_id").join(per_row, "row_id", "left").select(
        "doc_id", *counts, _written(base).alias("base"), _written(F.concat(base, added)).alias("spans"),
        F.size(added).cast("long").alias("n_bare"), F.size(alive).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0).cast("long")).alias("n_copied"), _written(alive).alias("live_spans"))
