"""Secret scans with multipart credential linking, in SQL functions only.

Base spans are the matches of three patterns. Weak candidates (client or user ids, bare
40-character keys, endpoints) are reported only where complementary parts co-occur: an
interval join within a scope of `scope` code points on either side. Scopes never leave a document, whose
spans sit in one array, so the join is a sort-merge sweep inside the row and nothing is
shuffled: the plan is one scan.

Match places come from cutting the text at the pattern: the i-th match starts after the
first i pieces and i matches. Texts without a match are told by one regular expression each
and cost no more.

Defined cases: null text is empty and has no spans; repeated rows are scanned each on its
own; a null doc_id is kept; extra columns are ignored; spans of one kind never overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import let

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak parts: by themselves they say nothing.
WEAK_ID = r"""((?i:client_?id|access_?key_?id|account|user_?name|user|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})"""
WEAK_KEY = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""(?i:https?|ftp|jdbc|redis|mongodb|postgres(?:ql)?|mysql|amqp|s3)(?::[a-z]{1,20})?://[^\s"'<>]{3,}|(?i:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"""

#: Order of kinds at one start.
KINDS = ("assign", "access", "hex", "weak_id", "weak_key", "endpoint")
SPAN = "array<struct<start:int,rank:int,end:int>>"


def _swept(items: Column, first: Column, move, keep, span) -> Column:
    """The spans span(state, item) of the items that keep(state, item) holds for, the state going on by move(state, item).

    A fold copies its array whenever it adds to it. Items are folded in chunks of about the root of their number, each with
    an array of its own, so n spans cost about n**1.5 copied references instead of n squared.
    """
    none = F.expr(f"cast(array() as {SPAN})")

    def step(acc: Column, x: Column) -> Column:
        more = F.concat(acc["out"], F.array(span(acc["state"], x)))
        return F.struct(move(acc["state"], x).alias("state"), F.when(keep(acc["state"], x), more).otherwise(acc["out"]).alias("out"))

    def chunk(acc: Column, own: Column) -> Column:
        done = F.aggregate(own, F.struct(acc["state"].alias("state"), none.alias("out")), step)
        return let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], d["out"]).alias("out")))

    def cut(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        return let(width, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), w), lambda i: F.slice(v, i, w)))

    return F.aggregate(let(items, cut), F.struct(first.alias("state"), none.alias("out")), chunk, lambda a: a["out"])


def _spans(text: Column, pattern: str, rank: int, least_group: tuple[int, int] | None = None) -> Column:
    """array<struct<start, rank, end>> of the pattern's matches; least_group: (group, least length) of those to keep."""
    none = F.expr(f"cast(array() as {SPAN})")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(least_group[0])) if least_group else matches
    least = least_group[1] if least_group else 0
    # The pieces between matches, without the last.
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    lengths = F.arrays_zip(
        F.transform(pieces, lambda x: F.length(x)).alias("gap"), F.transform(matches, lambda x: F.length(x)).alias("own"), F.transform(groups, lambda x: F.length(x)).alias("group")
    )

    def one(at: Column, x: Column) -> Column:
        lo = at + x["gap"]
        return F.struct(lo.alias("start"), F.lit(rank).alias("rank"), (lo + x["own"]).alias("end"))

    found = _swept(lengths, F.lit(0), lambda at, x: at + x["gap"] + x["own"], lambda at, x: x["group"] >= least, one)
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def _near(spans: Column, others: Column, scope: int) -> Column:
    """The spans that have one of the others, not overlapping them, within the scope.

    Both sides are put in order of place and swept once each way: forth by the others' ends and the spans'
    starts, back by the others' starts and the spans' ends. So the last other passed is the nearest
    that doesn't overlap, whatever longer ones lie around it.
    """
    none = F.expr(f"cast(array() as {SPAN})")

    def tagged(mine: str, other: str, order: int) -> Column:
        """order: of the others among what is at one place, where spans have 1."""
        one = F.transform(spans, lambda x: F.struct(x[mine].alias("at"), F.lit(1).alias("mine"), x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))
        two = F.transform(others, lambda x: F.struct(x[other].alias("at"), F.lit(order).alias("mine"), x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))
        return F.array_sort(F.concat(one, two))

    far = F.lit(-1_000_000_000)

    def swept(events: Column, first: Column) -> Column:
        return _swept(
            events, first, lambda last, x: F.when(x["mine"] == 1, last).otherwise(x["at"]), lambda last, x: (x["mine"] == 1) & (F.abs(x["at"] - last) <= scope),
            lambda last, x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")),
        )

    both = F.array_sort(F.concat(swept(tagged("start", "end", 0), far), swept(F.reverse(tagged("end", "start", 2)), -far)))
    # Sorted, so a span found both ways stands beside itself; array_union would compare structs all with all.
    once = let(both, lambda v: F.filter(v, lambda x, i: (i == 0) | (x != F.get(v, i - 1))))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), once).otherwise(none)


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"], x["end"])), ",")


def scan(docs: DataFrame, scope: int = 160) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and the number of linked weak parts."""
    none = F.expr(f"cast(array() as {SPAN})")
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.select(
        "doc_id", "text", _spans(F.col("text"), ASSIGN, 0, (2, 6)).alias("assign"), _spans(F.col("text"), ACCESS, 1).alias("access"), _spans(F.col("text"), HEX, 2).alias("hex"),
        _spans(F.col("text"), WEAK_KEY, 4).alias("key"),
    )
    # Ids and endpoints matter only beside a secret, or an access identifier's text.
    worth = (F.size("assign") > 0) | (F.size("hex") > 0) | (F.size("key") > 0)
    d = d.select(
        "doc_id", "assign", "access", "hex", "key",
        F.when(worth, _spans(F.col("text"), WEAK_ID, 3)).otherwise(none).alias("id"), F.when(worth, _spans(F.col("text"), ENDPOINT, 5)).otherwise(none).alias("endpoint"),
    )
    d = d.withColumn("base", F.array_sort(F.concat("assign", "access", "hex"))).withColumn("secrets", F.concat("assign", "hex", "key"))
    d = d.withColumn("ids", F.concat("access", "id"))
    d = d.withColumn(
        "weak",
        F.concat(
            _near(F.col("key"), F.concat("ids", "endpoint"), scope),
            _near(F.col("id"), F.col("secrets"), scope),
            _near(F.col("endpoint"), F.col("secrets"), scope),
        ),
    )
    return d.select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _told(F.array_sort(F.concat("base", "weak"))).alias("spans"),
        F.size("weak").cast("long").alias("n_linked"),
    )
