"""Secret scan with corpus-wide ownership of the values found.

Candidates come from fixed patterns. The hash of each value is counted over distinct owners
and distinct repositories: a value that many owners or many repositories carry is an example that was
copied around; a value that stays with few of both and looks random is a live credential.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import pick
from clinflow.llm.spans import find, of_kind, written
from clinflow.operators.storage import materialize

# Fixed values of the contract: kinds in order, patterns, least lengths.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

LIVE, EXAMPLE = "live", "example"
RANKS = {"assign": 0, "access": 1, "hex": 2, LIVE: 3, EXAMPLE: 4}


def candidates(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """(row, doc_id, owner, repository, spans): the base spans of every row, without its text.

    A value that fails its kind's length is dropped after matching, as the contract says. For hex
    runs the least length is in the pattern: a run is maximal either way.
    """
    rows = pick(docs, doc_id="doc_id:bigint", text="text:string", owner=f"{owner}:string",
                repository=f"{repository}:string")
    text = F.coalesce("text", F.lit(""))
    # Group 2 is the value, and it ends where the match ends.
    spans = F.filter(F.concat(
        find(text, ASSIGN, "assign", 0, group=2), find(text, ACCESS, "access", 1),
        find(text, HEX, "hex", 2)),
        lambda s: F.char_length(s["value"]) >= F.element_at(
            F.create_map(*[F.lit(x) for kv in LEAST.items() for x in kv]), s["kind"]))
    return rows.select("doc_id", "owner", "repository", spans.alias("spans")).withColumn(
        "row", F.monotonically_increasing_id())


def ownership(found: DataFrame, example_owners: int, example_repositories: int,
              least_distinct: int) -> DataFrame:
    """(h, verdict) for each value's hash.

    Counts run in two steps, (value, owner, repository) to (value, owner) to value, so each is combined
    before its shuffle and a value that a third of all rows carry costs one row per task. A missing
    owner or repository counts as one of its own.
    """
    each = found.where(F.size("spans") > 0).select(
        "owner", "repository", F.explode("spans").alias("s")).select(
        F.sha2("s.value", 256).alias("h"), "owner", "repository",
        F.size(F.array_distinct(F.split("s.value", ""))).alias("distinct"))
    by_repository = each.groupBy("h", "owner", "repository").agg(F.max("distinct").alias("distinct"))
    by_owner = by_repository.groupBy("h", "owner").agg(
        F.count("*").alias("repositories"), F.max("distinct").alias("distinct"))
    by_value = by_owner.groupBy("h").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
        F.max("distinct").alias("distinct"))
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    verdict = F.when(copied, EXAMPLE).when(F.col("distinct") >= least_distinct, LIVE)
    return by_value.select("h", "owners", "repositories", verdict.alias("verdict"))


def scan(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", example_owners: int = 3,
    example_repositories: int = 10, least_distinct: int = 6,
) -> DataFrame:
    """(doc_id, base, spans) for every row: arrays of (start, stop, rank, kind, value).

    ``base`` has the pattern matches. ``spans`` adds one span for each value with a verdict, at the
    value's place: ``example`` from ``example_owners`` distinct owners or ``example_repositories`` distinct
    repositories on, else ``live`` if the value has
    ``least_distinct`` different characters. NULL and empty texts have no spans; repeated rows come
    back as often as they came; without an owner column all rows have one owner. An empty table
    gives no rows.
    """
    found = materialize(candidates(docs, owner, repository), "candidates")
    verdicts = materialize(
        ownership(found, example_owners, example_repositories, least_distinct).where("verdict is not null"), "verdicts")
    some = found.where(F.size("spans") > 0)
    marked = some.select("row", F.explode("spans").alias("s")).withColumn(
        "h", F.sha2("s.value", 256)).join(verdicts, "h")
    rank = F.when(F.col("verdict") == LIVE, RANKS[LIVE]).otherwise(RANKS[EXAMPLE])
    added = marked.groupBy("row").agg(F.collect_set(F.struct(
        (F.col("s.stop") - F.char_length("s.value")).alias("start"), F.col("s.stop").alias("stop"),
        rank.alias("rank"), F.col("verdict").alias("kind"), F.col("s.value").alias("value"))
    ).alias("added"))
    with_added = some.join(added, "row", "left").select(
        "doc_id", F.col("spans").alias("base"),
        F.when(F.col("added").isNull(), F.col("spans")).otherwise(F.concat("spans", "added"))
        .alias("spans"))
    return found.where(F.size("spans") == 0).select(
        "doc_id", F.col("spans").alias("base"), "spans").union(with_added)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the contract from ``scan``'s spans."""
    return found.select(
        "doc_id", *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in LEAST],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))
