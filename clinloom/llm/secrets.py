"""Secret scans with multipart credential linking, on SQL functions alone.

Base kinds, leftmost and non-overlapping for each kind: ``assign`` (a keyword, an assignment sign and a
value of six characters or more), ``access`` (an access identifier of 20 or more) and ``hex`` (24 or
more). The method adds ``weak`` spans: a token of 32 base-64 characters or more that mixes cases and
digits (a possible secret key; a sign of assignment may stand before it), a user or client identifier assignment,
and an endpoint (a data store's or queue's URL, or a web URL whose host has a service word). No one of them is
reported alone. Texts are cut into scopes at blank lines; an interval join within each scope, a sweep over its
parts in order of their starts, reports a weak part only when a complementary part lies within ``reach``
characters: a secret with an identifier or an endpoint, an identifier or an endpoint with a secret; base
spans count as their role. An identifier and an endpoint alone are no credential. Parts are taken as whole runs.

The join needs no shuffle, so one popular text costs its own length alone. Matches are gathered in blocks of
``BLOCK``; what is left of the square is one reference a block and match. The sweep appends linked parts one by
one, so a text of n linked weak parts copies n * n / 2 short structs: some thousands of them take seconds.

Nulls and edge cases: a null text is empty; a document without spans has zero counts, the digest of the
empty string and empty ``spans``; weak spans that overlap a base span are dropped; of equal starts the base span
comes first, then the one that ends first; repeated and very long texts are scanned whole; an empty table gives no
rows; other columns pass through ``scan`` and ``redact``, but ``base`` and ``added`` of ``scan`` replace those of
their names; the query doesn't read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: both take a whole run
HEX = r"[0-9a-f]{24,}"  # likewise
LEAST_VALUE = 6
#: Weak parts by role.
WEAK = {
    "secret": r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=])",
    "identifier": r"(?i)\b(?:client_?id|account_?id|access_?key_?id|user(?:name)?)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}",
    "endpoint": r"(?i)\b(?:(?:amqps?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|rediss?|s3)://[A-Za-z0-9_.:@/-]{3,}"
    r"|https?://(?=[A-Za-z0-9_.:@-]*(?:api|auth|login|oauth|sso|vault|storage|blob|queue|sqs|registry|gateway|database|db))[A-Za-z0-9_.:@/-]{3,})",
}
#: Characters between complementary parts at most, unless the caller says otherwise.
REACH = 300
#: Roles that complement each role.
COMPLEMENT = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
#: Matches gathered at a time.
BLOCK = 64
#: The role in which a base span complements weak parts.
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret"}


def _matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Arrays of struct<start, end, value>: a pattern's matches in code points, ends exclusive, found by
    cutting the text at the matches and adding up lengths. ``value`` is the group, or else empty."""
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    inner = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1)) if group else F.transform(whole, lambda _: F.lit(""))
    gaps = F.split(text, pattern, -1)
    pieces = F.arrays_zip(
        F.transform(gaps, lambda g: F.length(g)).alias("gap"), F.transform(whole, lambda m: F.length(m)).alias("len"), inner.alias("value")
    )
    kind = "array<struct<start:int,end:int,value:string>>"
    empty = F.array().cast(kind)

    def step(state, piece):
        first = state["at"] + piece["gap"]
        last = first + F.coalesce(piece["len"], F.lit(0))
        one = F.struct(first.alias("start"), last.alias("end"), piece["value"].alias("value"))
        found = F.when(piece["len"].isNotNull(), F.concat(state["found"], F.array(one))).otherwise(state["found"])
        return F.struct(last.alias("at"), found.alias("found"))

    # in blocks, so that an array that grows is short
    def block(state, k):
        done = F.aggregate(F.slice(pieces, k + 1, BLOCK), F.struct(state["at"].alias("at"), empty.alias("found")), step)
        return F.struct(done["at"].alias("at"), F.concat(state["blocks"], F.array(done["found"])).alias("blocks"))

    few = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda s: s["found"])
    starts = F.sequence(F.lit(0), F.size(gaps) - 1, F.lit(BLOCK))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("blocks"))
    many = F.aggregate(starts, start, block, lambda s: F.flatten(s["blocks"]))
    # most texts have no match, and are not cut
    return F.when(~text.rlike(pattern), empty).when(F.size(gaps) <= BLOCK, few).otherwise(many)


def _spans(found: Column, kind: str, rank: int, role: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(role).alias("role")),
    )


def _free(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column has them."""
    taken = {c.lower() for c in df.columns}
    return [next(n + "_" * k for k in range(1, len(taken) + 2) if n + "_" * k not in taken) for n in names]


def scan(df: DataFrame, text: str = "text", reach: int = REACH, base_to: str = "base", added_to: str = "added") -> DataFrame:
    """``df`` with ``base`` and ``added`` (or columns of other names), arrays of struct<start, rank, end, kind, role>
    in order."""
    weak_in, scopes_in, base_in = _free(df, "weak", "scopes", "found")
    body = F.coalesce(F.col(text), F.lit(""))
    value_long = lambda m: F.length(m["value"]) >= LEAST_VALUE
    base = F.array_sort(
        F.concat(
            _spans(F.filter(_matches(body, ASSIGN, 1), value_long), "assign", 0, ROLES["assign"]),
            _spans(_matches(body, ACCESS), "access", 1, ROLES["access"]),
            _spans(_matches(body, HEX), "hex", 2, ROLES["hex"]),
        )
    )
    weak = F.array_sort(F.concat(*[_spans(_matches(body, p), "weak", 3, role) for role, p in WEAK.items()]))
    # every scope's end; a scope is a stretch between blank lines
    scopes = F.transform(_matches(body, r"\n[ \t\r]*\n"), lambda m: m["start"])
    found = df.withColumns({base_in: base, weak_in: weak})
    some = F.size(weak_in) > 0
    found = found.withColumn(scopes_in, F.when(some, scopes).otherwise(F.array().cast("array<int>")))
    added = F.when(some, linked(F.col(base_in), F.col(weak_in), F.col(scopes_in), reach)).otherwise(F.col(weak_in))
    return found.withColumns({base_to: F.col(base_in), added_to: added}).drop(weak_in, scopes_in, base_in)


def linked(base: Column, weak: Column, scopes: Column, reach: int = REACH) -> Column:
    """Those of ``weak`` that overlap no base span and have a complementary part, base or such a weak one, in their
    scope, at most ``reach`` characters away: one sweep forward and one back over all parts. State holds the
    nearest part's edge by role, emptied where a scope ends."""
    none = -(1 << 30)
    marks = F.transform(
        scopes, lambda s: F.struct(s.alias("start"), F.lit(-1).alias("rank"), s.alias("end"), F.lit("scope").alias("kind"), F.lit("").alias("role"))
    )
    clear = F.filter(weak, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    parts = F.array_sort(F.concat(marks, base, clear))

    def sweep(ordered: Column, near: str, far: str, sign: int) -> Column:
        initial = F.struct(*[F.lit(none).alias(r) for r in WEAK], F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,role:string>>").alias("kept"))

        def step(state, p):
            is_scope = p["kind"] == "scope"
            close = F.lit(False)
            for r in WEAK:
                close = close | (p["role"].isin(*COMPLEMENT[r]) & (sign * p[near] - state[r] <= reach))
            after = [F.when(is_scope, none).when(p["role"] == r, F.greatest(state[r], sign * p[far])).otherwise(state[r]).alias(r) for r in WEAK]
            kept = F.when((p["kind"] == "weak") & close, F.concat(state["kept"], F.array(p))).otherwise(state["kept"])
            return F.struct(*after, kept.alias("kept"))

        return F.aggregate(ordered, initial, step, lambda s: s["kept"])

    forward = sweep(parts, "start", "end", 1)
    back = sweep(F.reverse(parts), "end", "start", -1)
    return F.array_sort(F.array_union(forward, back))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """``df`` with every found span of ``text``, base or linked, replaced by ``mark``; overlapping spans
    become one. A null text stays null, other rows without spans stay as they were."""
    base, added = _free(df, "base", "added")
    scanned = scan(df, text, reach, base, added)
    spans = F.array_sort(F.concat(base, added))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.col(text)

    def step(state, s):
        inside = s["start"] < state["at"]
        piece = F.when(inside, F.lit("")).otherwise(F.concat(body.substr(state["at"] + 1, s["start"] - state["at"]), F.lit(mark)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    whole = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], body.substr(s["at"] + 1, F.length(body))))
    new = F.when(F.size(base) + F.size(added) > 0, whole).otherwise(body)
    return scanned.withColumn(text, new).drop(base, added)


def op6(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans; and n_weak."""
    found = scan(documents.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ROLES],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_weak"),
    )
