"""Secrets in texts: three patterns, and a battery of randomness tests.

Besides strings that look like assignments, access keys or hex digests, tokens, and the segments of
paths, are tested for randomness in the encoding that they seem to be in: chi-squared uniformity over its
alphabet, runs, and serial correlation. A token that passes counts as a secret only if text
would hardly look so even at its length; false discoveries are controlled over all documents.
Built-in expressions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlattice.session import store

# The patterns, and the least length of group 2 (assign) or of the match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ["assign", "access", "hex", "random"]
#: Characters of the candidates for the tests. "=" is no part of them but for padding at the end,
#: so that a name before it is cut off.
INNER = "[A-Za-z0-9+/_-]"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order in which they are tried: name, pattern, alphabet. Capitalised words are
#: not tested.
ENCODINGS = [
    ("word", r"^[A-Z][a-z]+$", ""),
    ("digits", r"^[0-9]+$", DIGITS),
    ("lower", r"^[a-z]+$", LOWER),
    ("upper", r"^[A-Z]+$", UPPER),
    ("hex", r"^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("hex upper", r"^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("base32", r"^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("base36", r"^[a-z0-9]+$", DIGITS + LOWER),
    ("base36 upper", r"^[A-Z0-9]+$", DIGITS + UPPER),
    ("base62", r"^[A-Za-z0-9]+$", DIGITS + LOWER + UPPER),
    ("base64", r"^[A-Za-z0-9+/]+$", DIGITS + LOWER + UPPER + "+/"),
    ("base64 url", r"^[A-Za-z0-9_-]+$", DIGITS + LOWER + UPPER + "_-"),
]
#: Of these most tokens are words and numbers. They must be so long that text looks as uniform a hundred
#: times less often than elsewhere, which no word is.
PLAIN = ("digits", "lower", "upper")
#: By how much more often than in uniform strings two symbols of text are equal.
TEXT_EXCESS = 0.045
#: Steps of log10(p) that the false-discovery control tells apart, and the last of them.
STEPS, LAST_STEP = 20, 400
#: Lengths beyond this are tested at any rate.
LONGEST = 4096
_MARK, _STAND_IN = "\u0001", "\u0002"


def let(value: Column, then) -> Column:
    """`then(value)` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def ends_of(pieces: Column, between: int = 0) -> Column:
    """Where each piece of a text ends, in code points, if `between` lie between two of them.

    Running sums by doubling the reach: as many passes as the number of pieces has binary digits.
    """
    sizes = F.transform(pieces, lambda p, i: F.char_length(p) + F.when(i > 0, between).otherwise(0))
    reach = F.sequence(F.lit(0), F.length(F.bin(F.size(pieces))) - 1)

    def further(sums: Column, k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(sums, lambda x, i: x + F.when(i >= step, F.get(sums, i - step)).otherwise(0))

    return F.aggregate(reach, sizes, further)


def matches(text: Column, pattern: str, keep) -> Column:
    """Array of (start, end, token) of the leftmost non-overlapping matches that `keep` holds
    for; code points. `text` must not contain the mark U+0001."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)

    def found(pieces: Column, ends: Column) -> Column:
        # Every other piece is a match, and none of the last.
        odd = F.sequence(F.lit(0), F.floor(F.size(pieces) / 2).cast("int") - 1)
        tokens = F.transform(odd, lambda j: F.struct(
            F.get(ends, 2 * j).alias("start"), F.get(ends, 2 * j + 1).alias("end"), F.get(pieces, 2 * j + 1).alias("token")))
        return F.filter(tokens, lambda m: keep(m["token"]))

    both = let(pieces, lambda p: let(ends_of(p), lambda e: found(p, e)))
    return F.when(text.rlike(pattern), both).otherwise(F.array().cast("array<struct<start:int,end:int,token:string>>"))


def normal_below(z: Column) -> Column:
    """P(Z <= z) of a normal variable, by a logistic curve (error below 0.0002)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def shortest(symbols: int, rate: float) -> int:
    """The least length at which a token over so many symbols can be a discovery at `rate`: shorter
    ones may come from text with a greater chance than that, however evenly they are spread."""
    for n in range(2, LONGEST):
        each, more = divmod(n, symbols)
        squares = more * (each + 1) ** 2 + (symbols - more) * each**2
        far = (n - 1) * symbols * TEXT_EXCESS
        z = max(-12.0, (squares * symbols / n - n - (symbols - 1) - far) / math.sqrt(2 * (symbols - 1) + 4 * far))
        if 1 / (1 + math.exp(-1.5976 * z - 0.07056 * z**3)) <= rate:
            return n
    return LONGEST


def shortest_of(rate: float) -> dict[str, int]:
    return {name: shortest(len(symbols), rate / 100 if name in PLAIN else rate) for name, _, symbols in ENCODINGS if symbols}


def candidate_pattern(least: dict[str, int]) -> str:
    """Whole runs of INNER that are long enough for some encoding, with their padding; words and numbers
    that are not long enough for their own aside."""
    short = {name: f"{{1,{least[name] - 1}}}" for name in PLAIN}
    words = f"[A-Z]?[a-z]{short['lower']}|[A-Z]{short['upper']}|[0-9]{short['digits']}|[A-Z][a-z]+"
    return rf"(?<!{INNER})(?!(?:{words})(?!{INNER})){INNER}{{{min(least.values())},}}(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"


def with_segments(candidates: Column) -> Column:
    """Candidates (start, end, token, part), and the segments between slashes of each that has
    any (part is true), which are tested on their own as well."""

    def segments(c: Column) -> Column:
        whole = F.array(F.struct(c["start"].alias("start"), c["end"].alias("end"), c["token"].alias("token"), F.lit(False).alias("part")))

        def parts(pieces: Column) -> Column:
            def part(piece: Column, end: Column) -> Column:
                end = c["start"] + end
                return F.struct((end - F.char_length(piece)).alias("start"), end.alias("end"), piece.alias("token"), F.lit(True).alias("part"))

            return F.zip_with(pieces, ends_of(pieces, between=1), part)

        split = let(F.split(c["token"], "/", -1), parts)
        return F.when(F.contains(c["token"], F.lit("/")), F.concat(whole, split)).otherwise(whole)

    return F.flatten(F.transform(candidates, segments))


def encoding(token: Column) -> Column:
    out = F
    for name, pattern, _ in ENCODINGS:
        out = out.when(token.rlike(pattern), name)
    return out.otherwise("mixed")


def tested(candidate: Column, least: dict[str, int]) -> Column:
    """(start, end, part, encoding, passes, step) of a candidate: whether it passes for random, and
    in which step of log10(p) the chance lies that text of its length looks as uniform. Null if
    its encoding is unknown, or if it is shorter than `least` of its encoding."""
    core = F.regexp_replace(candidate["token"], "=+$", "")
    name = encoding(core)
    alphabet, enough = F, F
    for known, _, symbols in ENCODINGS:
        alphabet = alphabet.when(name == known, symbols)
        enough = enough.when(name == known, F.lit(least.get(known, LONGEST)))
    alphabet, enough = alphabet.otherwise(""), enough.otherwise(F.lit(LONGEST))
    # Named once, so that each is worked out once.
    base = F.array(F.struct(core.alias("core"), name.alias("name"), alphabet.alias("alphabet"), F.char_length(core).cast("double").alias("n"),
                            F.char_length(alphabet).cast("double").alias("a"), enough.alias("least")))

    def symbols(x: Column) -> Column:
        places = F.transform(F.filter(F.split(x["core"], ""), lambda c: c != ""), lambda c: F.position(c, x["alphabet"]))
        squares = F.aggregate(
            F.array_distinct(F.filter(F.split(x["core"], ""), lambda c: c != "")),
            F.lit(0.0),
            lambda acc, c: acc + F.pow(x["n"] - F.char_length(F.replace(x["core"], c, F.lit(""))), F.lit(2.0)),
        )
        return F.struct(x["name"].alias("name"), x["n"].alias("n"), x["a"].alias("a"), places.alias("p"),
                        (squares * x["a"] / x["n"] - x["n"]).alias("chi"))

    def centred(x: Column) -> Column:
        # Worked out here, as what a lambda names is worked out for each of its elements.
        mean = F.aggregate(x["p"], F.lit(0.0), lambda acc, v: acc + v) / F.size(x["p"])
        return F.struct(*[x[c].alias(c) for c in ("name", "n", "a", "p", "chi")], mean.alias("mean"))

    def sums(x: Column) -> Column:
        n, mean = F.size(x["p"]), x["mean"]
        above = F.aggregate(x["p"], F.lit(0.0), lambda acc, v: acc + F.when(v > x["a"] / 2, 1.0).otherwise(0.0))
        pairs = F.zip_with(F.slice(x["p"], 1, n - 1), F.slice(x["p"], 2, n - 1), lambda u, v: F.struct(u.alias("u"), v.alias("v")))
        runs = F.aggregate(pairs, F.lit(1.0), lambda acc, q: acc + F.when((q["u"] > x["a"] / 2) != (q["v"] > x["a"] / 2), 1.0).otherwise(0.0))
        spread = F.aggregate(x["p"], F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean))
        lagged = F.aggregate(pairs, F.lit(0.0), lambda acc, q: acc + (q["u"] - mean) * (q["v"] - mean))
        return F.struct(
            x["name"].alias("name"), x["n"].alias("n"), x["a"].alias("a"), x["chi"].alias("chi"), above.alias("above"),
            runs.alias("runs"), F.when(spread > 0, lagged / spread).alias("serial"),
        )

    def judged(x: Column) -> Column:
        n, df = x["n"], x["a"] - 1
        spread = 2 / (9 * df)
        uniform = (F.pow(x["chi"] / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
        twice = 2 * x["above"] * (n - x["above"])
        runs = (x["runs"] - twice / n - 1) / F.sqrt(F.greatest(twice * (twice - n) / (n * n * (n - 1)), F.lit(1e-9)))
        serial = (x["serial"] + 1 / (n - 1)) * F.sqrt(n)
        least = F.least(normal_below(-uniform), 2 * normal_below(-F.abs(runs)), 2 * normal_below(-F.abs(serial)))
        passes = (twice > 0) & x["serial"].isNotNull() & (3 * least >= 0.01)
        far = (n - 1) * x["a"] * TEXT_EXCESS
        text_like = normal_below((x["chi"] - df - far) / F.sqrt(2 * df + 4 * far))
        step = F.least(F.lit(LAST_STEP), F.floor(-F.log10(text_like) * STEPS).cast("int"))
        return F.struct(
            candidate["start"].alias("start"), candidate["end"].alias("end"), candidate["part"].alias("part"), x["name"].alias("encoding"),
            F.coalesce(passes, F.lit(False)).alias("passes"), F.coalesce(step, F.lit(0)).alias("step"),
        )

    known = F.filter(base, lambda x: (x["alphabet"] != "") & (x["n"] >= x["least"]))
    return F.get(F.transform(F.transform(F.transform(F.transform(known, symbols), centred), sums), judged), 0)


def scan(docs: DataFrame, rate: float) -> DataFrame:
    """Per row of `docs`: doc_id, the base spans of each kind, and the tested candidates."""
    least = shortest_of(rate)
    candidate = candidate_pattern(least)
    text = F.translate(F.coalesce("text", F.lit("")), _MARK, _STAND_IN)
    held = docs.select("doc_id", text.alias("t"))
    found = held.select(
        "doc_id",
        matches(F.col("t"), ASSIGN, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= LEAST["assign"]).alias("assign"),
        matches(F.col("t"), ACCESS, lambda m: F.char_length(m) >= LEAST["access"]).alias("access"),
        # Shorter runs are whole matches as well, so that asking for the length finds the same.
        matches(F.col("t"), HEX[:-1] + "{%d,}" % LEAST["hex"], lambda m: F.lit(True)).alias("hex"),
        with_segments(matches(F.col("t"), candidate, lambda m: F.lit(True))).alias("candidates"),
    )
    judged = F.filter(F.transform("candidates", lambda c: tested(c, least)), lambda c: c.isNotNull())
    return found.select("doc_id", "assign", "access", "hex", judged.alias("candidates"))


def discovery_steps(scanned: DataFrame, rate: float) -> dict[str, int]:
    """Per encoding the least step from which on candidates count (Benjamini-Hochberg).

    Candidates of all documents are counted by encoding and step: a table of bounded size.
    """
    each = scanned.select(F.explode("candidates").alias("c")).select("c.encoding", "c.passes", "c.step")
    counted = each.groupBy("encoding", "step").agg(F.count("*").alias("n"), F.sum(F.col("passes").cast("long")).alias("passed"))
    by_step = Window.partitionBy("encoding").orderBy(F.desc("step"))
    all_of = Window.partitionBy("encoding")
    p_most = F.pow(F.lit(10.0), -F.col("step") / F.lit(float(STEPS)))
    ranked = counted.select(
        "encoding", "step", F.sum("passed").over(by_step).alias("up_to"), F.sum("n").over(all_of).alias("all"), p_most.alias("p")
    )
    good = ranked.where(F.col("p") * F.col("all") <= rate * F.col("up_to")).groupBy("encoding").agg(F.min("step").alias("step"))
    return {r["encoding"]: r["step"] for r in good.collect()}


def find_secrets(docs: DataFrame, false_discovery_rate: float = 0.01) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start, then kind; base_sha256
    is over those of the patterns (the hash of an empty string if there are none), `spans` also
    has kind `random`. Null and empty texts have no spans. Repeated rows come out as often as
    they come in; null ids are carried along; other columns are ignored. An empty table gives no rows.
    A text of any length is searched whole, in time in proportion to it but for a logarithm of its matches.
    """
    scanned = store(scan(docs, false_discovery_rate), "secrets-scan")
    steps = discovery_steps(scanned, false_discovery_rate)
    enough = F.lit(False)
    kept = "candidates"
    if steps:
        least = F.create_map(*[F.lit(x) for item in sorted(steps.items()) for x in item])
        kept = F.filter("candidates", lambda c: c["passes"] & F.coalesce(c["step"] >= least[c["encoding"]], F.lit(False)))
    else:
        kept = F.filter("candidates", lambda c: enough)

    # A segment of a path is not told once more where the whole path counts.
    inside = lambda c, w: ~w["part"] & (w["start"] <= c["start"]) & (w["end"] >= c["end"])
    alone = F.filter("kept", lambda c: ~(c["part"] & F.exists(F.col("kept"), lambda w: inside(c, w))))

    def marked(spans, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end")))

    def joined(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(
            F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.concat(*[marked(k, i) for i, k in enumerate(KINDS[:3])])
    return scanned.withColumn("kept", kept).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat(base, marked(alone, 3))).alias("spans"),
    )
