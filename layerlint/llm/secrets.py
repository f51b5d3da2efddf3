"""Secrets in texts: key patterns, and tokens that pass a battery of randomness tests.

Everything is a column expression. Each candidate token gets an inferred encoding and three p-values under "drawn evenly from
that encoding's alphabet": chi-squared of the symbol counts, the number of runs above and below the middle of the alphabet, and
the serial correlation of neighbours. The battery's p-value is three times the smallest. Words written with an encoding's
symbols give tiny values; random tokens spread evenly. So, per encoding and length class, the share of non-random tokens among
those above a cut is estimated from all tokens of all texts, and the lowest cut with a share of at most ``rate`` is used.
Short tokens mix both kinds at every cut and then get no cut at all: nothing is claimed where the tests have no power.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from layerlint.session import prepare

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: name: (what a token of it looks like, its alphabet in order); the first that fits is inferred
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    "HEX": (r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567"),
    "base36": (r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", DIGITS + LOWER),
    "BASE36": (r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", DIGITS + UPPER),
    "base64": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    "base64url": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
}
CUTS = [i / 100 for i in (1, 2, 5, 10, 15, 20, 25, 30, 40, 50)]
CENTRE = 0.5  # tokens above it are taken to be random


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, value) in code points; value is the group."""
    found, values = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    between = F.split(text, pattern, -1)
    steps = F.aggregate(
        F.sequence(F.lit(1), F.size(found)),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out")),
        lambda s, i: F.struct(
            (s["at"] + F.length(F.element_at(between, i)) + F.length(F.element_at(found, i))).alias("at"),
            F.concat(s["out"], F.array(F.struct(
                (s["at"] + F.length(F.element_at(between, i))).alias("start"),
                (s["at"] + F.length(F.element_at(between, i)) + F.length(F.element_at(found, i))).alias("end"),
                F.element_at(values, i).alias("value"),
            ))).alias("out"),
        ),
    )["out"]
    # most texts have no match, and a sequence of 1 to 0 would count down
    return F.when(text.rlike(pattern), steps).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, to about 1e-7."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * F.abs(z))
    poly = t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429)))))
    tail = F.exp(-z * z / 2) / F.lit(2.5066282746310002) * poly
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def inferred_encoding(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (shape, _) in reversed(ENCODINGS.items()):
        out = F.when(token.rlike(shape), F.lit(name)).otherwise(out)
    return out


def alphabet(encoding: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for name, (_, letters) in ENCODINGS.items() for x in (name, letters)]), encoding)


def battery(token: Column, letters: Column) -> Column:
    """Struct (chi, runs, serial, p) of a token over an ordered alphabet."""
    n, k = F.length(token).cast("double"), F.length(letters).cast("double")
    x = F.transform(F.split(token, ""), lambda c: (F.instr(letters, c) - 1).cast("double"))

    def over(x: Column) -> Column:
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda s, v: s + F.pow(F.size(F.filter(x, lambda w: w == v)).cast("double"), 2.0))
        chi = k / n * squares - n
        free = k - 1
        chi_z = (F.pow(chi / free, 1 / 3) - (1 - F.lit(2.0) / (9 * free))) / F.sqrt(F.lit(2.0) / (9 * free))
        sums = F.aggregate(
            x, F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("c"), F.lit(0.0).alias("up"), F.lit(0.0).alias("runs")),
            lambda s, v: F.struct(
                v.alias("last"), (s["s"] + v).alias("s"), (s["q"] + v * v).alias("q"),
                (s["c"] + F.when(s["last"] >= 0, s["last"] * v).otherwise(0.0)).alias("c"),
                (s["up"] + F.when(v >= k / 2, 1.0).otherwise(0.0)).alias("up"),
                (s["runs"] + F.when((s["last"] < 0) | ((s["last"] >= k / 2) != (v >= k / 2)), 1.0).otherwise(0.0)).alias("runs"),
            ),
        )

        def tests(t: Column) -> Column:
            mean = t["s"] / n
            first, last = F.element_at(x, 1), F.element_at(x, -1)
            spread = t["q"] - n * mean * mean
            covariance = t["c"] - mean * (2 * t["s"] - first - last) + (n - 1) * mean * mean
            serial_z = (covariance / spread + F.lit(1.0) / n) * F.sqrt(n)
            expected = 1 + 2 * t["up"] * (n - t["up"]) / n
            runs_z = (t["runs"] - expected) / F.sqrt((expected - 1) * (expected - 2) / (n - 1))
            chi_p = upper_tail(chi_z)
            runs_p = F.when((t["up"] == 0) | (t["up"] == n), 0.0).otherwise(2 * upper_tail(F.abs(runs_z)))
            serial_p = F.when(spread <= 0, 0.0).otherwise(2 * upper_tail(F.abs(serial_z)))
            return F.struct(chi_p.alias("chi"), runs_p.alias("runs"), serial_p.alias("serial"), F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p)).alias("p"))

        return F.element_at(F.transform(F.array(sums), tests), 1)

    return F.element_at(F.transform(F.array(x), over), 1)


def length_class(token: Column) -> Column:
    """Half octaves of the length above 20."""
    return F.floor(F.log2(F.length(token) / 20.0) * 2).cast("int")


def tested_tokens(text: Column) -> Column:
    """Candidate tokens with an inferred encoding: structs (start, end, encoding, class, p)."""
    found = F.transform(matches(text, CANDIDATE), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("token"), inferred_encoding(m["value"]).alias("encoding")))
    fitting = F.filter(found, lambda m: m["encoding"].isNotNull())
    return F.transform(fitting, lambda m: F.struct(m["start"], m["end"], m["encoding"], length_class(m["token"]).alias("class"), battery(m["token"], alphabet(m["encoding"]))["p"].alias("p")))


def discovery_cuts(docs: DataFrame, text: str = "text", rate: float = 0.05) -> dict[tuple[str, int], float]:
    """The lowest p-value that counts as random per (encoding, length class), from all tokens of all texts.

    At most encodings * length classes rows come to the driver.
    """
    tokens = docs.select(F.explode(tested_tokens(F.coalesce(F.col(text), F.lit("")))).alias("t")).select("t.*")
    counts = tokens.groupBy("encoding", "class").agg(
        F.count_if(F.col("p") > CENTRE).alias("centre"), *[F.count_if(F.col("p") >= c).alias(f"c{i}") for i, c in enumerate(CUTS)],
    ).collect()
    cuts = {}
    for r in counts:
        # chance that three even p-values all exceed a third of the cut
        random = r["centre"] / (1 - CENTRE / 3) ** 3
        for i, c in enumerate(CUTS):
            above = r[f"c{i}"]
            if above and above - random * (1 - c / 3) ** 3 <= rate * above:
                cuts[r["encoding"], r["class"]] = c
                break
    return cuts


def find_secrets(docs: DataFrame, text: str = "text", rate: float = 0.05, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row: ``keep`` columns, n_assign, n_access, n_hex, n_random, base_sha256, spans (string kind:start:end, ...).

    Offsets are code points, end exclusive. A random token is added where it touches no span of a key pattern. Null and empty
    texts have no span and the digest of an empty string. Repeated rows are searched each; other columns are ignored; an
    empty table gives no rows.
    """
    prepare(docs.sparkSession)
    cuts = discovery_cuts(docs, text, rate)
    body = F.coalesce(F.col(text), F.lit(""))

    def spans(found: Column, kind: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    rows = docs.select(*keep, body.alias("__text")).select(
        *keep,
        spans(F.filter(matches(F.col("__text"), ASSIGN, 1), lambda m: F.length(m["value"]) >= 6), 0).alias("assign"),
        spans(matches(F.col("__text"), ACCESS), 1).alias("access"), spans(matches(F.col("__text"), HEX), 2).alias("hex"),
        tested_tokens(F.col("__text")).alias("tokens"),
    )
    if cuts:
        table = F.create_map(*[F.lit(x) for (e, c), v in cuts.items() for x in (f"{e}:{c}", v)])
        cut = lambda m: F.coalesce(F.element_at(table, F.concat(m["encoding"], F.lit(":"), m["class"].cast("string"))), F.lit(2.0))
    else:
        cut = lambda m: F.lit(2.0)
    base = F.array_sort(F.concat("assign", "access", "hex"))
    rows = rows.withColumn("base", base)
    fresh = F.filter("tokens", lambda m: (m["p"] >= cut(m)) & ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    rows = rows.withColumn("random", spans(fresh, 3))

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(F.lit(list(KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return rows.select(
        *keep, *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "random"))).alias("spans"),
    )
