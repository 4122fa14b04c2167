"""Personal data by candidate gradient boosting (DataFrame operations only).

Strict patterns with their checks (number of digits, Luhn, range) give the base spans. Looser generators, one for
each kind, propose candidates that may overlap each other and the base. Boosted trees score a candidate by format
(kind, digits, separators, groups, first character) and context (neighbouring characters, a word before it that
announces the kind). Their labels are weak: a candidate is positive if it is a base span. All candidates are counted
by their features in one aggregation; trees and thresholds are worked out from that table and become one Column. The
features are small whole numbers, so the table has at most 5.6 million cells whatever the input (a few thousand in
practice), and none is left out. A kind's threshold is the lowest score at which candidates of the held-out half are
base spans with at least PRECISION. Candidates over it that overlap nothing better join the base spans: what looks
just like personal data though a check fails, such as an address with a part over 255.

Secrets (values of tokens, keys and passwords) are a fifth kind that works alike. They are returned apart from the four.

Positions come from cutting the text at the matches: a match starts where the lengths before it add up to.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .boosting import as_column, fit_trees, totals
from .common import same, stored

KINDS = ["email", "ip", "card", "phone"]
#: Kinds with patterns: KINDS, and secrets as the last one.
ALL, SECRET = [*KINDS, "secret"], len(KINDS)
#: The strict patterns, written so that no text makes them slow: runs are possessive and tried from their start only.
STRICT = [
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
    r"(?<![\w+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[\w+/-]{16})(?<=(?i:token|secret|passw|password|passwd|key|auth)[\"']?[ ]{0,2}[=:][ ]{0,2}[\"']?)[A-Za-z0-9_+/-]++",
]
LOOSE = [
    r"(?:\G|(?<![\p{L}\p{N}._%+'-]))[\p{L}\p{N}._%+'-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*+",
    r"(?<![0-9.:])[0-9]++(?:[.:][0-9]++){3,7}+",
    r"[0-9](?:[ ./-]?[0-9])++",
    r"(?<![0-9+(])[+(]{0,2}[0-9](?:[ ()./-]{0,3}[0-9])++",
    r"(?<![\w+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+",
]
#: What a text must contain for a pattern to match.
NEEDS = ["@", ".", "", "+", "", "@", "", "", "", ""]
#: Words that announce each kind, before a candidate.
HINTS = [r"(?i)mail|contact|write", r"(?i)\bip\b|host|addr|server", r"(?i)card|visa|credit|pay|iban", r"(?i)phone|tel\b|call|mobile|fax|cell", r"(?i)token|secret|passw|key|auth|bearer"]
PRECISION = 0.9
FEATURES = ["f_kind", "f_digits", "f_marks", "f_groups", "f_first", "f_before", "f_after", "f_hint"]
ROW = ["_id", "_hash", "_len"]


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def passes(kind: Column, text: Column) -> Column:
    """Whether a strict match meets its kind's check."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    n = F.length(digits)
    part_ok = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
    small = lambda p: F.regexp_replace(p, "^0+(?=.)", "").cast("int") <= 255
    parts = F.split(text, r"\.")
    return (
        F.when((kind == 0) | (kind == SECRET), F.lit(True))
        .when(kind == 1, F.when(F.forall(parts, part_ok), F.forall(parts, small)).otherwise(False))
        .when(kind == 2, F.when((n >= 13) & (n <= 19), luhn(digits)).otherwise(False))
        .otherwise((n >= 9) & (n <= 15))
    )


def char_class(c: Column) -> Column:
    return F.when((c == "") | c.isNull(), 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{N}]"), 2).when(c.rlike(r"""[.,;:!?)\]"'|]"""), 3).otherwise(4)


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each match of a pattern: ROW, f_* features, _loose, _ok, _start, _end."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.length(text_col).alias("_len"), text.alias("_t"))
    rows = rows.where(F.col("_t").rlike("[0-9@]"))
    cuts = []
    for k, (pattern, need) in enumerate(zip(STRICT + LOOSE, NEEDS, strict=True)):
        fits = F.contains("_t", F.lit(need)) if need else F.lit(True)
        cuts.append(F.struct(F.lit(k).alias("_k"), F.when(fits, F.split("_t", pattern)).alias("_p"), F.when(fits, F.regexp_extract_all("_t", F.lit(pattern), 0)).alias("_m")))
    cut = rows.select(*ROW, F.explode(F.array(*cuts)).alias("_c")).select(*ROW, "_c.*").where(F.size("_m") > 0)
    after = F.slice("_p", 2, F.size("_m"))
    each = cut.select(*ROW, "_k", F.posexplode(F.arrays_zip(F.slice("_p", F.lit(1), F.size("_m")).alias("b"), F.col("_m").alias("m"), after.alias("a"))).alias("_i", "_x"))
    match, kind = F.col("_x.m"), F.col("_k") % len(ALL)
    tail, digits = F.right("_x.b", F.lit(24)), F.regexp_replace("_x.m", "[^0-9]", "")
    has = lambda marks, bit: F.when(F.translate(match, marks, "") != match, bit).otherwise(0)
    each = each.select(
        *ROW, "_k", "_i", F.length("_x.b").alias("_before"), F.length(match).alias("_size"),
        F.when(F.col("_k") < len(ALL), passes(kind, match)).otherwise(False).alias("_ok"),
        kind.alias("f_kind"),
        F.least(F.length(digits), F.lit(21)).alias("f_digits"),
        (has(" ", 1) + has("-", 2) + has(".", 4) + has("()", 8)).alias("f_marks"),
        F.least(F.size(F.split(match, r"[^\p{L}\p{N}]+")), F.lit(8)).alias("f_groups"),
        F.when(match.startswith("+"), 0).when(match.startswith("("), 1).when(match.rlike("^[0-9]"), 2).otherwise(3).alias("f_first"),
        char_class(F.right("_x.b", F.lit(1))).alias("f_before"),
        char_class(F.left("_x.a", F.lit(1))).alias("f_after"),
        reduce(lambda rest, h: F.when((kind == h[0]) & tail.rlike(h[1]), 1).otherwise(rest), enumerate(HINTS), F.lit(0)).alias("f_hint"),
    ).distinct()
    upto = Window.partitionBy(*ROW, "_k").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_before") + F.col("_size")).over(upto)
    placed = each.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_size"))
    # Of failed strict matches nothing is needed once the positions are known.
    return placed.withColumn("_loose", F.col("_k") >= len(ALL)).where(F.col("_loose") | F.col("_ok")).drop("_k", "_i", "_before", "_size")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `id_col`, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_secret,
    secret_spans, n_found.

    The counts and base_sha256 are of the base spans; spans has the base spans and those that the method adds, each
    kind:start:end in code points, by kind as in KINDS, then start. n_secret and secret_spans have the secrets, and
    n_found counts all spans of either column. A null or empty text has none; texts of any length are read whole. Of
    overlapping added spans the first wins, of those with one start the longest, then the first kind. Repeated rows
    give repeated results; rows that share an id are told apart by their text. An empty table gives an empty result.
    Other columns are not read, so their names can't clash.
    """
    found = stored(matches(docs, id_col, text_col), "matches")
    base = found.where(~F.col("_loose")).select(*ROW, "f_kind", "_start", "_end", F.lit(True).alias("_base"))
    loose = found.where("_loose").drop("_ok", "_loose")
    on = [loose[c].eqNullSafe(base[c]) for c in ROW] + [loose[c] == base[c] for c in ("f_kind", "_start", "_end")]
    loose = loose.join(base, on, "left").select(*[loose[c] for c in loose.columns], F.coalesce("_base", F.lit(False)).alias("_base"))

    half = F.pmod(F.col("_hash"), F.lit(2)).cast("int").alias("_half")
    cells = loose.groupBy(*FEATURES, half).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_base").cast("long")).alias("y"))
    score, over = trained(cells.toArrow())

    rest = loose.where(~F.col("_base")).withColumn("_score", score)
    rest = rest.where(over).select(*ROW, "f_kind", "_start", "_end", F.lit(False).alias("_base"))
    both = base.union(rest)
    of_doc = Window.partitionBy(*ROW)
    order = of_doc.orderBy("_start", F.desc("_base"), F.desc("_end"), "f_kind")
    before = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("_base"), F.col("_start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    kept = both.withColumn("_to", before).withColumn("_next", following)
    free = (F.coalesce("_to", F.lit(0)) <= F.col("_start")) & (F.coalesce("_next", F.col("_end")) >= F.col("_end"))
    kept = kept.where(F.col("_base") | free)

    names = F.array(*map(F.lit, ALL))
    lines = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["s"], s["e"])), ",")
    span, secret = F.struct(F.col("f_kind").alias("k"), F.col("_start").alias("s"), F.col("_end").alias("e")), F.col("f_kind") == SECRET
    listed = lambda which, name: lines(F.collect_list(F.when(which, span))).alias(name)
    counts = [F.count_if(F.col("_base") & (F.col("f_kind") == k)).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    counts += [F.count_if(~F.col("_base") & ~secret).alias("n_added"), F.count_if(secret).alias("n_secret"), F.count(F.lit(1)).alias("n_found")]
    per_doc = kept.groupBy(*ROW).agg(*counts, listed(F.col("_base") & ~secret, "_base_spans"), listed(~secret, "_spans"), listed(secret, "_secrets"))
    per_doc = per_doc.withColumnsRenamed({c: f"{c}2" for c in ROW})
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.length(text_col).alias("_len"))
    out = rows.join(per_doc, reduce(Column.__and__, [same(rows[c], per_doc[f"{c}2"]) for c in ROW]), "left")
    number = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    return out.select(
        F.col("_id").alias(id_col),
        *[number(f"n_{name}") for name in KINDS],
        F.sha2(F.coalesce("_base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("_spans", F.lit("")).alias("spans"),
        number("n_added"),
        number("n_secret"),
        F.coalesce("_secrets", F.lit("")).alias("secret_spans"),
        number("n_found"),
    )


def trained(table: pa.Table) -> tuple[Column, Column]:
    """The score of a candidate, and whether it is over the threshold of its kind."""
    # In a fixed order, so that sums of floats don't depend on that of the rows.
    table = table.sort_by([(c, "ascending") for c in [*FEATURES, "_half"]])
    x = np.array([table.column(f).to_numpy() for f in FEATURES], int).T.reshape(-1, len(FEATURES))
    half, n, y = (table.column(c).to_numpy() for c in ("_half", "n", "y"))
    learn, hold = half == 0, half == 1
    if not learn.any():
        return F.lit(0.0), F.lit(False)
    base, trees = fit_trees(x[learn], n[learn].astype(float), y[learn].astype(float))
    scores, over = totals(base, trees, x), F.lit(False)
    for kind in range(len(ALL)):
        own = np.flatnonzero(hold & (x[:, FEATURES.index("f_kind")] == kind))
        own = own[np.argsort(-scores[own], kind="stable")]
        last = np.append(np.diff(scores[own]) < 0, True)[: len(own)]  # of cells with one score
        good = np.flatnonzero(last & (np.cumsum(y[own]) >= PRECISION * np.cumsum(n[own])))
        if len(good):
            over = over | ((F.col("f_kind") == kind) & (F.col("_score") >= float(scores[own[good[-1]]]) - 1e-9))
    return as_column(base, trees, [F.col(f) for f in FEATURES]), over
