"""Secret scan with corpus-wide ownership frequency, with built-in expressions only.

Candidates are the matches of three base patterns (assignments to a key word, access ids, long hex strings) and of one
loose pattern, long strings of mixed letters and digits that overlap no match of the base patterns. The hashes of their values are counted over the whole corpus
by distinct repositories and owners. A value of many owners, or of several owners in many repositories, is an example
that was copied widely; a value that few owners have, in few repositories or all in those of one owner, is a live-looking
credential. Base spans are always reported, whatever their
label; of the loose candidates only live-looking ones are, as kind `owned`.

Values are counted after distinct (value, owner, repository) rows were made, so a value that fills a third of the corpus is
reduced before it is dealt out. A label is joined to candidate rows only; texts are read once.

Defined results: a null or empty text has no spans; a null owner or repository counts as one owner of its own, named
by the empty string; repeated rows are reported each; an empty table gives no rows; very long texts are scanned whole, in steps
that grow with their length and the number of their matches. Only the named columns are used, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetweave.llm.matches import replaced, spans, touches
from assetweave.llm.scratch import land

# The base patterns, in the order of their kinds.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of 24 or more is the whole run, as [0-9a-f]+ finds it
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

LOOSE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}(?![A-Za-z0-9+/_-])"
MANY_OWNERS = 5
MANY_REPOSITORIES = 10  # of two owners or more
KINDS = ("assign", "access", "hex", "owned")


def _by_kind(text: Column) -> list[Column]:
    """The base spans of each kind, sorted and apart from each other."""
    assign = F.filter(spans(text, ASSIGN, KINDS[0], 0, 2), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    access = F.filter(spans(text, ACCESS, KINDS[1], 1), lambda s: F.length(s["value"]) >= ACCESS_LEAST)
    return [assign, access, spans(text, HEX, KINDS[2], 2)]


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*_by_kind(text)))


def candidates(text: Column) -> Column:
    """Base spans, and loose ones that overlap none of them."""
    def put(it: Column) -> Column:
        kinds = [it[k] for k in KINDS[:3]]
        loose = F.filter(it["loose"], lambda s: ~(touches(s, kinds[0]) | touches(s, kinds[1]) | touches(s, kinds[2])))
        return F.concat(F.array_sort(F.concat(*kinds)), loose)

    found = F.struct(*[c.alias(k) for c, k in zip(_by_kind(text), KINDS[:3])], loose_spans(text).alias("loose"))
    return F.get(F.transform(F.array(found), put), F.lit(0))


def loose_spans(text: Column) -> Column:
    """Long strings with lower and upper letters and digits."""
    mixed = [r"[a-z]", r"[A-Z]", r"[0-9].*[0-9]"]
    return F.filter(spans(text, LOOSE, KINDS[3], 3), lambda s: s["value"].rlike(mixed[0]) & s["value"].rlike(mixed[1]) & s["value"].rlike(mixed[2]))


def ownership(candidates: DataFrame, value: str = "value", owner: str = "owner", repository: str = "repository") -> DataFrame:
    """(value, owners, repositories) of each value, from its distinct rows."""
    once = candidates.groupBy(value, owner, repository).agg(F.lit(1).alias("_one"))
    by_owner = once.groupBy(value, owner).agg(F.count("*").alias("repositories"))
    return by_owner.groupBy(value).agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(docs: DataFrame, text: str = "text", owner: Column | None = None, repository: Column | None = None, many_owners: int = MANY_OWNERS) -> DataFrame:
    """(doc_id, base, spans): sorted arrays of (start, order, end, kind, label, owners, repositories) in code points.

    The label is `live` or `example`. The source of a document is its owner, source and language its repository, unless
    other columns are given.
    """
    return scanned(docs, text, owner, repository, ["doc_id"], many_owners).select("row.*", "base", "spans")


def scanned(
    docs: DataFrame, text: str, owner: Column | None, repository: Column | None, keep: list[str], many_owners: int = MANY_OWNERS
) -> DataFrame:
    """(row, base, spans): `row` is a struct of the columns `keep`, so that no names clash."""
    owner = docs["source"] if owner is None else owner
    repository = F.concat_ws("/", docs["source"], docs["lang"]) if repository is None else repository
    kept = [docs[c] for c in keep]
    whole = F.coalesce(docs[text], F.lit(""))
    found = land(docs.select(
        F.struct(*kept).alias("row"), F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"),
        F.monotonically_increasing_id().alias("number"),
        _hashed(candidates(whole)).alias("found"),
    ), "secret-candidates")
    rows = found.where(F.size("found") > 0).select("number", "owner", "repository", F.inline("found"))
    owners = land(ownership(rows), "owners", found.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0])  # a bare table, so that adaptive execution can split a value that fills the corpus
    spread = (F.col("owners") >= 2) & (F.col("repositories") >= MANY_REPOSITORIES)
    label = F.when((F.col("owners") >= many_owners) | spread, "example").otherwise("live")
    span = F.struct("start", "order", "end", "kind", label.alias("label"), "owners", "repositories")
    labelled = rows.join(owners, "value").select("number", span.alias("span"))
    again = labelled.groupBy("number").agg(F.array_sort(F.collect_list("span")).alias("all"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,label:string,owners:bigint,repositories:bigint>>")
    both = found.select("number", "row").join(again, "number", "left").withColumn("all", F.coalesce("all", none))
    return both.select(
        "row", F.filter("all", lambda s: s["order"] < 3).alias("base"),
        F.filter("all", lambda s: (s["order"] < 3) | (s["label"] == "live")).alias("spans"),
    )


def _hashed(spans_: Column) -> Column:
    """Values leave the text as hashes only."""
    return F.transform(spans_, lambda s: s.withField("value", F.sha2(s["value"], 256)))


def redact(text: Column, spans_: Column, mark: str = "[SECRET]") -> Column:
    """The text with a mark in place of each live span; overlapping spans become one mark."""
    live = F.filter(spans_, lambda s: s["label"] == "live")
    return F.when(F.size(live) == 0, text).otherwise(replaced(F.coalesce(text, F.lit("")), live, mark))


def redact_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with live secrets masked, and `n_chars` of the new text where that column exists."""
    found = scanned(docs, text, None, None, docs.columns)
    old = F.col("row")[text]
    new = redact(old, F.col("spans"))
    columns = {c: F.col("row")[c] for c in docs.columns} | {text: new}
    if "n_chars" in docs.columns:
        size = F.when(old.isNull(), F.col("row")["n_chars"]).otherwise(F.length(new))
        columns["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return found.select(*[c.alias(name) for name, c in columns.items()])
