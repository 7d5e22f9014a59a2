"""Secret scan by corpus-wide ownership frequency.

Patterns propose candidates; who holds a value decides what it is. Each candidate's
value is hashed, and for the whole corpus the different owners and repositories that
hold the hash are counted:

* ``example``: held by more than ``max_owners`` owners, or by more than one owner and
  more than ``max_repositories`` repositories. Documentation keys and copied snippets.
* ``live``: held by few, and it looks random (long, of letters and digits, many different
  characters). A credential of its owner.
* ``plain``: held by few, but no credential by its looks.

Spans of the base patterns are always returned, with their verdict. Spans of the wider
patterns (private keys, web tokens, issued tokens, logins in addresses, long mixed runs)
are added only if they are ``live`` and overlap no base span. Spans are in code points,
end exclusive; those of one kind never overlap and are found leftmost first.

Everything is built-in column functions. Positions come from the pieces between matches,
summed in blocks, so a text with very many matches costs no more per match. Texts are
read once; what is shuffled are spans with hashed values. Owners are counted per value
and owner and repository, then per value and owner, then per value, each combined in
the map tasks first, so a value in a third of all rows costs one row per task. The
verdicts are joined by shuffle, where Spark splits a hot value.

Nulls: a null text is empty; a null id, owner or repository is a value like any other.
Repeated rows are scanned each, and a repository given by a hash of the text counts
them once. Ties in a span's start go by the order of kinds. Empty tables give empty
results. Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.session import materialize

MAX_OWNERS = 3
MAX_REPOSITORIES = 20
# What looks random: so many characters, and so many different ones.
RANDOM_CHARS = 16
RANDOM_DIFFERENT = 10
BLOCK = 512


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the secret, and the shortest that counts."""

    name: str
    pattern: str
    value: int = 0
    least: int = 1


# The base patterns. The two of one character class are written with their
# least length: a run too short then holds no match, as if it were matched and dropped.
BASE = (
    Kind(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}"),
    Kind("hex", r"[0-9a-f]{24,}"),
)

# Wider patterns, tried in this order at each place.
WIDER = (
    Kind("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    Kind("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("issued", r"(?:gh[opsu]_|glpat-|xox[abprs]-|[sr]k_live_|AIza|npm_|hf_)[A-Za-z0-9_-]{16,}"),
    Kind("login", r"[a-z][a-z0-9+.]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{6,128}@"),
    Kind("mixed", r"[A-Za-z0-9+/_=-]{20,}"),
)
WIDER_PATTERN = "|".join(f"(?:{k.pattern})" for k in WIDER)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(numbers: Column) -> Column:
    """Running sums of an array, in blocks: each number is copied BLOCK times at most."""

    def sums(part: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("sum"))
        step = lambda s, x: F.struct(
            F.array_append(s["out"], s["sum"] + x).alias("out"), (s["sum"] + x).alias("sum")
        )
        return F.aggregate(part, start, step, lambda s: s["out"])

    def joined(blocks: Column) -> Column:
        ends = sums(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return F.flatten(
            F.transform(
                F.arrays_zip(blocks.alias("block"), ends.alias("end")),
                lambda z: _let(
                    z["end"] - F.element_at(z["block"], -1),
                    lambda before: F.transform(z["block"], lambda x: x + before),
                ),
            )
        )

    def blocks(all_numbers: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(all_numbers), F.lit(BLOCK))
        return _let(F.transform(firsts, lambda i: sums(F.slice(all_numbers, i, BLOCK))), joined)

    return _let(numbers, blocks)


def matches(text: Column, pattern: str, value: int = 0) -> Column:
    """Array of ``(start, end, value, whole)`` of all matches; ``value`` is a group."""
    regex = F.lit(pattern)
    chars = lambda part: F.char_length(part).cast("bigint")
    none = F.array().cast("array<struct<start: bigint, end: bigint, value: string, whole: string>>")
    # Text between matches, then the match: one piece more than there are matches.
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), chars).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("whole"),
        (F.regexp_extract_all(text, regex, F.lit(value)) if value else F.array()).alias("value"),
    )
    spans = _let(
        F.filter(zipped, lambda z: z["whole"].isNotNull()),
        lambda found: F.transform(
            F.arrays_zip(
                _running(F.transform(found, lambda z: z["gap"] + chars(z["whole"]))).alias("end"),
                found.alias("found"),
            ),
            lambda z: F.struct(
                (z["end"] - chars(z["found"]["whole"])).alias("start"),
                z["end"].alias("end"),
                (z["found"]["value"] if value else z["found"]["whole"]).alias("value"),
                z["found"]["whole"].alias("whole"),
            ),
        ),
    )
    return F.when(F.regexp_like(text, regex), spans).otherwise(none)


def looks_random(value: Column) -> Column:
    """Long, with letters and digits, and of many different characters."""
    return (
        (F.char_length(value) >= RANDOM_CHARS)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= RANDOM_DIFFERENT)
    )


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def candidates(text: Column) -> Column:
    """Array of ``(start, kind, end, v1, v2, random)``; kinds count up over BASE, WIDER."""

    def span(number: Column, found: Column) -> Column:
        return F.struct(
            found["start"].alias("start"),
            number.cast("int").alias("kind"),
            found["end"].alias("end"),
            F.xxhash64(found["value"]).alias("v1"),
            F.xxhash64(F.lit(7), found["value"]).alias("v2"),
            looks_random(found["value"]).alias("random"),
        )

    def of_kind(number: int, kind: Kind) -> Column:
        long = F.filter(
            matches(text, kind.pattern, kind.value), lambda m: F.char_length(m["value"]) >= kind.least
        )
        return F.transform(long, lambda m: span(F.lit(number), m))

    parts = [of_kind(number, kind) for number, kind in enumerate(BASE)]

    def wider(found: Column) -> Column:
        number = F.lit(len(BASE) + len(WIDER) - 1)
        for i in reversed(range(len(WIDER) - 1)):
            number = F.when(found["whole"].rlike(f"^(?:{WIDER[i].pattern})$"), len(BASE) + i).otherwise(number)
        return span(number, found)

    # Of the long runs only those of mixed characters; the others have a form of their own.
    parts.append(
        F.transform(
            F.filter(matches(text, WIDER_PATTERN), lambda m: m["whole"].rlike("[^A-Za-z0-9+/_=-]") | _mixed(m["whole"])),
            wider,
        )
    )
    return F.concat(*parts)


def ownership(held: DataFrame) -> DataFrame:
    """``(v1, v2, owners, repositories)`` of ``held(v1, v2, owner, repository)``.

    A repository counts once per owner.
    """
    return (
        held.groupBy("v1", "v2", "owner", "repository").agg(F.lit(1).alias("one"))
        .groupBy("v1", "v2", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("v1", "v2")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    owner: str | Column = "source",
    repository: str | Column | None = None,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Per row: the id and ``spans``, an array of ``(start, end, kind, base, verdict,
    owners, repositories)`` in order of start, then kind.

    Without a ``repository``, each different text is one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    holder = F.col(repository) if isinstance(repository, str) else repository
    scanned = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).alias("id"),
            (F.col(owner) if isinstance(owner, str) else owner).alias("owner"),
            (F.xxhash64(body) if holder is None else holder).alias("repository"),
            candidates(body).alias("found"),
        ),
        "secret-candidates",
    )
    flat = scanned.where(F.size("found") > 0).select("row", "owner", "repository", F.inline("found"))
    counted = ownership(flat.select("v1", "v2", "owner", "repository"))
    copied = (F.col("owners") > max_owners) | (
        (F.col("owners") > 1) & (F.col("repositories") > max_repositories)
    )
    base = F.col("kind") < len(BASE)
    in_order = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    backwards = (
        Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    )
    judged = (
        flat.join(counted, ["v1", "v2"])
        .withColumn(
            "verdict",
            F.when(copied, "example").when(F.col("random"), "live").otherwise("plain"),
        )
        .withColumn("reached", F.max(F.when(base, F.col("end"))).over(in_order))
        .withColumn("next", F.min(F.when(base, F.col("start"))).over(backwards))
        .where(
            base
            | (
                (F.col("verdict") == "live")
                & (F.coalesce("reached", F.lit(0)) <= F.col("start"))
                & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
            )
        )
    )
    names = F.array(*(F.lit(k.name) for k in (*BASE, *WIDER)))
    span = F.struct("start", "kind", "end", "verdict", "owners", "repositories")
    listed = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    named = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.element_at(names, s["kind"] + 1).alias("kind"),
            (s["kind"] < len(BASE)).alias("base"),
            s["verdict"].alias("verdict"),
            s["owners"].alias("owners"),
            s["repositories"].alias("repositories"),
        ),
    )
    none = F.array().cast(
        "array<struct<start: bigint, end: bigint, kind: string, base: boolean, verdict: string, "
        "owners: bigint, repositories: bigint>>"
    )
    return (
        scanned.select("row", "id")
        .join(listed, "row", "left")
        .select(F.col("id").alias(id_column), F.coalesce(named, none).alias("spans"))
    )
