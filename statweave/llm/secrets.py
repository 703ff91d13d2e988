"""Secrets in texts, with Spark expressions only.

Base kinds are patterns that stand alone. Weak parts (identifiers, keys, endpoints) are
reported only together: an interval join finds which parts of other roles lie within one
scope of them in the same text, counted from the end of one part to the start of the other.

Places come from the pattern itself: cutting a text at its matches gives the gaps between
them, and running sums of gap and match lengths are the offsets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, written

# The base kinds with pattern, group that is measured, and its least length.
WORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({WORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]{14,}", 0, 18), ("hex", "[0-9a-f]{16,}", 0, 16))
# Runs are greedy, so asking for 14 or 16 characters finds the runs that a filter of `+` matches would leave.
WEAK = (
    ("id", "[A-Z][A-Z0-9]{11,}"),
    ("key", "[A-Za-z0-9+/]{20,}"),
    ("endpoint", r"""https?://[^\x00-\x20"'<>]{4,}|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(:[0-9]{2,5})?"""),
)
KINDS = [k[0] for k in BASE] + [k[0] for k in WEAK]
SCOPE = 200  # code points between parts that belong together, at most
PLACE = "struct<at:int,kind:int,end:int>"


def _spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """array<PLACE> of the matches whose group has `least` characters; end is exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), sized.alias("sized"))
    number = KINDS.index(kind)

    def step(state: Column, x: Column) -> Column:
        at = state["at"] + F.length(x["gap"])
        end = at + F.coalesce(F.length(x["hit"]), F.lit(0))
        place = F.struct(at.alias("at"), F.lit(number).alias("kind"), end.alias("end"))
        keeps = F.coalesce(F.length(x["sized"]) >= least, F.lit(False)) & x["hit"].isNotNull()
        return F.struct(end.alias("at"), F.when(keeps, F.concat(state["found"], F.array(place))).otherwise(state["found"]).alias("found"))

    none = F.array().cast(f"array<{PLACE}>")
    found = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("found")), step)["found"]
    return F.when(text.rlike(pattern), found).otherwise(none)


def _apart(weak: Column, base: Column) -> Column:
    """Weak parts that no base span touches: those are reported anyway."""
    return F.filter(weak, lambda w: ~F.exists(base, lambda b: (b["at"] < w["end"]) & (w["at"] < b["end"])))


def _joined(spans: Column) -> Column:
    named = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", named[s["kind"]], s["at"], s["end"])), ",")


def _near(parts: DataFrame, others: DataFrame) -> DataFrame:
    """Parts with at most a scope between them and one of the others: joined by text and stretch of text.

    A part is dealt to every stretch that it touches, the left side also to those within a
    scope of it, so parts of any length meet.
    """
    def stretches(at: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(at / SCOPE), F.floor(end / SCOPE)))

    left = parts.withColumn("stretch", stretches(F.col("at") - SCOPE, F.col("end") + SCOPE))
    right = others.select(F.col("key").alias("key_"), F.col("at").alias("at_"), F.col("end").alias("end_"), stretches(F.col("at"), F.col("end")).alias("stretch_"))
    met = left.join(right, (F.col("key") == F.col("key_")) & (F.col("stretch") == F.col("stretch_"))
                    & (F.greatest("at", "at_") - F.least("end", "end_") <= SCOPE), "left_semi")
    return met.drop("stretch").distinct()


def _parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, row key, base spans and weak parts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("key"), text.alias("text"))
    rows = rows.withColumn("base", F.concat(*(_spans(F.col("text"), *kind) for kind in BASE)))

    def mixed(w: Column) -> Column:
        """Identifiers and keys have letters and digits; else they are words or numbers."""
        own = F.col("text").substr(w["at"] + 1, w["end"] - w["at"])
        return own.rlike("[0-9]") & own.rlike("[A-Za-z]")

    weak = F.filter(F.concat(*(_spans(F.col("text"), *kind) for kind in WEAK)), lambda w: (w["kind"] == KINDS.index("endpoint")) | mixed(w))
    return written(rows.withColumn("weak", _apart(weak, F.col("base"))).drop("text"), "spans")


def _linked(rows: DataFrame) -> DataFrame:
    """Per row key: the weak parts that have a part of another role in scope."""
    parts = rows.select("key", F.explode(F.concat("base", "weak")).alias("p")).select("key", "p.*").distinct()

    def of(*kinds: str) -> DataFrame:
        return parts.where(F.col("kind").isin([KINDS.index(k) for k in kinds]))

    secrets, holders = of("assign", "hex", "key"), of("access", "id")
    confirmed = reduce(DataFrame.union, [
        _near(of("id"), secrets), _near(of("key"), holders.union(of("endpoint"))), _near(of("endpoint"), secrets.union(holders))])
    return confirmed.groupBy("key").agg(F.collect_set(F.struct("at", "kind", "end")).alias("linked"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, joined), linked (array of at, kind, end).

    `linked` are the weak parts with complements in scope: an identifier near a key or base
    secret; a key near an identifier, an access key or an endpoint; an endpoint near any of
    the other two. NULL texts count as empty and have no spans; repeated rows come out as
    often as they came in. Other columns are not read.
    """
    rows = _parts(docs, id_col, text_col)
    out = rows.join(_linked(rows), "key", "left").withColumn("linked", F.coalesce("linked", F.array().cast(f"array<{PLACE}>")))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return out.select(
        F.col("id").alias(id_col), *(count(k[0]) for k in BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "linked")).alias("spans"), "linked")


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The rows of `docs`, all columns as they were, with secrets masked in the text: base kinds, linked identifiers and keys.

    Texts without a secret, and NULL, stay as they are; no row is dropped.
    """
    linked = written(_linked(_parts(docs, id_col, text_col)).select(
        F.col("key").alias("__key"), F.filter("linked", lambda s: s["kind"] != KINDS.index("endpoint")).alias("__linked")), "linked")
    keyed = docs.withColumn("__key", row_key(F.col(id_col), F.col(text_col))).join(linked, "__key", "left")
    text, none = F.col(text_col), F.array().cast(f"array<{PLACE}>")
    spans = F.array_sort(F.concat(*(_spans(text, *kind) for kind in BASE), F.coalesce(F.col("__linked"), none)))

    def step(state: Column, s: Column) -> Column:
        """Copy what lies between spans; spans may overlap (a hex run inside an assigned value)."""
        between = text.substr(state["at"] + 1, F.greatest(s["at"] - state["at"], F.lit(0)))
        out = F.when(s["at"] >= state["at"], F.concat(state["out"], between, F.lit(mask))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    masked = F.concat(done["out"], text.substr(done["at"] + 1, F.length(text)))
    touched = reduce(lambda a, b: a | b, (text.rlike(pattern) for _, pattern, *_ in BASE), F.coalesce(F.size("__linked") > 0, F.lit(False)))
    return keyed.withColumn(text_col, F.when(touched, masked).otherwise(text)).select(*docs.columns)
