"""Secrets in texts: rules, and character Markov models of random strings against ordinary identifiers.

Everything is DataFrame functions.  Rules find assignments, access keys and long hexadecimal runs.
Beyond them, runs of key characters with letters and digits are candidates; a first-order Markov
model of random strings and one of identifiers, both trained from a labelled sample, score
them, and those whose log-likelihood ratio is high enough are secrets too, of kind ``markov``, unless
they overlap a span of a rule.  The models are one number for each pair of characters.

Work grows with a text's length: lists of matches are passed over in about as many parts as a part has matches, so that no
list grows by one at a time, and strings are taken apart into characters once.

Places are code points, the end exclusive.  Defined results: a null text is empty, and has no spans.
Repeated rows are scanned each for itself.  Texts are scanned whole.  Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run is matched whole, so a shorter one holds no match
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_VALUE = 12

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
LEAST_RATIO = 12.0  # nats
SAMPLE_DOCS = 2_000  # bound of the documents whose identifiers are the sample
SAMPLE_RANDOM = 2_000
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _none(depth: int = 1) -> Column:
    return F.expr(f"cast(array() as {'array<' * (depth - 1)}{_SPAN}{'>' * (depth - 1)})")


def _once(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pass(rows: Column, state: Column, step) -> Column:
    """Spans of one ordered pass: ``step`` takes the state and a row, and gives the next state, a span and whether to keep it."""
    def inner(acc: Column, row: Column) -> Column:
        after, span, good = step(acc["state"], row)
        return F.struct(after.alias("state"), F.when(good, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def outer(acc: Column, rows: Column) -> Column:
        done = F.aggregate(rows, F.struct(acc["state"].alias("state"), _none().alias("spans")), inner, lambda d: F.struct(d["state"].alias("state"), F.array_append(acc["lists"], d["spans"]).alias("lists")))
        return done

    def whole(rows: Column) -> Column:
        part = F.greatest(F.ceil(F.sqrt(F.size(rows).cast("double"))).cast("int"), F.lit(1))
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / part).cast("int")), lambda i: F.slice(rows, i * part + 1, part))
        done = F.aggregate(parts, F.struct(state.alias("state"), _none(2).alias("lists")), outer, lambda acc: F.flatten(acc["lists"]))
        return F.when(F.size(rows) > 0, done).otherwise(_none())

    return _once(rows, whole)


def _span(start: Column, kind: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"))


def _spans(text: Column, pattern: str, kind: int, wanted=None, group: int | None = None) -> Column:
    """Spans of all matches; only those whose text (or group) is ``wanted``, if that is given."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    other = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.zip_with(F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))), other, lambda a, v: F.struct(a["m"].alias("m"), a["g"].alias("g"), v.alias("v")))

    def step(at: Column, row: Column):
        begin = at + F.coalesce(row["g"], F.lit(0))
        end = begin + F.coalesce(F.length(row["m"]), F.lit(0))
        good = row["m"].isNotNull() if wanted is None else row["m"].isNotNull() & wanted(row["v"])
        return end, _span(begin, F.lit(kind), end), good

    return F.when(text.rlike(pattern), _pass(rows, F.lit(0), step)).otherwise(_none())


def base_spans(text: Column) -> Column:
    """Spans (start, kind as its place in ``KINDS``, end) of the rules, by start, then kind."""
    parts = [_spans(text, ASSIGN, 0, lambda v: F.length(v) >= ASSIGN_VALUE, 2), _spans(text, ACCESS, 1), _spans(text, HEX, 2)]
    return F.array_sort(F.concat(*parts))


def ratio(text: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string of ``ALPHABET``, random against identifier."""
    llr = F.expr(f"array({','.join(f'{x:.9f}D' for x in table)})")
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pairs = lambda own: F.zip_with(own, F.slice(own, 2, F.size(own)), lambda a, b: F.coalesce(F.get(llr, a * len(ALPHABET) + b), F.lit(0.0)))
    return F.aggregate(_once(codes, pairs), F.lit(0.0), lambda acc, x: acc + x)


def added_spans(text: Column, base: Column, table: list[float], least: float = LEAST_RATIO) -> Column:
    """Spans of candidates that the models take for random and no rule has found."""
    random = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (ratio(v, table) >= least)
    spans = _spans(text, CANDIDATE, 3, random)
    is_rule = lambda s: s["kind"] < 3

    def apart(spans: Column) -> Column:
        # From the left, with the furthest end of a rule's span so far; what is left of the candidates from the right, with the next start.
        both = F.array_sort(F.concat(base, spans))
        left = _pass(both, F.lit(0), lambda end, s: (F.when(is_rule(s), F.greatest(end, s["end"])).otherwise(end), s, ~is_rule(s) & (s["start"] >= end)))
        again = F.reverse(F.array_sort(F.concat(base, left)))
        right = _pass(again, F.lit(2**31 - 1), lambda start, s: (F.when(is_rule(s), F.least(start, s["start"])).otherwise(start), s, ~is_rule(s) & (s["end"] <= start)))
        return F.when((F.size(spans) == 0) | (F.size(base) == 0), spans).otherwise(F.reverse(right))

    return _once(spans, apart)


def train(labelled: DataFrame) -> list[float]:
    """The table of ``ratio`` from rows (value, secret); at most one count for each label and pair of characters comes back."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substr(F.col("value"), i, F.lit(2)))
    rows = labelled.filter("length(value) > 1 AND secret IS NOT NULL").select("secret", F.explode(pairs).alias("pair"))
    rows = rows.filter(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("secret", "pair").agg(F.count("*").alias("n"))
    counts = {(r["secret"], r["pair"]): r["n"] for r in rows.collect()}
    out = []
    for a in ALPHABET:
        total = {s: sum(counts.get((s, a + b), 0) for b in ALPHABET) + len(ALPHABET) for s in (True, False)}
        out += [math.log((counts.get((True, a + b), 0) + 1) / total[True]) - math.log((counts.get((False, a + b), 0) + 1) / total[False]) for b in ALPHABET]
    return out


def random_strings(spark: SparkSession, n: int = SAMPLE_RANDOM) -> DataFrame:
    """``n`` digests, as base 64, hexadecimal and capitals with digits."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    capitals = F.upper(F.conv(F.substring(digest, 1, 15), 16, 36))
    value = F.when(F.col("id") % 3 == 0, F.rtrim(F.base64(F.unhex(digest)), F.lit("="))).when(F.col("id") % 3 == 1, digest).otherwise(F.concat(capitals, F.upper(F.conv(F.substring(digest, 16, 15), 16, 36))))
    return spark.range(n).select(value.alias("value"), F.lit(True).alias("secret"))


def labelled_sample(docs: DataFrame, bound: int = SAMPLE_DOCS) -> DataFrame:
    """Random strings, labelled as secrets, and the identifiers of at most ``bound`` documents outside the rules' spans.

    The documents are those whose id has the smallest hash, and do not depend on the order of rows.
    """
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    plain = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = rows.select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("value"), F.lit(False).alias("secret"))
    return random_strings(docs.sparkSession).union(words)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, table: list[float]) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text), n_markov."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("t")).select("doc_id", "t", base_spans(F.col("t")).alias("base"))
    rows = rows.select("doc_id", "base", added_spans(F.col("t"), F.col("base"), table).alias("added"))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_markov"),
    )


def redacted(docs: DataFrame, table: list[float], mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced; overlapping spans are one."""
    rows = docs.withColumn("__base", base_spans(F.coalesce(F.col("text"), F.lit(""))))
    rows = rows.withColumn("__added", added_spans(F.coalesce(F.col("text"), F.lit("")), F.col("__base"), table))
    spans, letters = F.array_sort(F.concat("__base", "__added")), F.split(F.col("text"), "")
    # What stays lies between the spans, each stretch followed by the mark; overlapping spans leave none.
    stays = _pass(spans, F.lit(0), lambda at, s: (F.greatest(at, s["end"]), _span(at, F.lit(0), s["start"]), s["start"] >= at))
    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    cut = lambda own: F.concat(
        F.array_join(F.transform(stays, lambda s: F.concat(F.array_join(F.slice(own, s["start"] + 1, s["end"] - s["start"]), ""), F.lit(mark))), ""),
        F.array_join(F.slice(own, last + 1, F.size(own)), ""),
    )
    whole = _once(letters, cut)
    return rows.withColumn("text", F.when(F.size("__base") + F.size("__added") > 0, whole).otherwise(F.col("text"))).select(*docs.columns)
