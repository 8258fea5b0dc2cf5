"""Secret scans in DataFrame functions only: fixed patterns, and a battery of randomness tests.

The battery looks at long tokens. Each gets the smallest encoding that fits it (letters, hex, base32, letters and
digits, base64); digits alone are of the kind hex whatever they look like. Three tests then ask whether its characters look like uniform draws from that alphabet: chi-squared of the
counts, runs above and below the middle of the alphabet, and serial correlation. Fisher's method joins their
p-values; a token that isn't rejected looks random.

Short tokens of ordinary text are often not rejected either. So the threshold depends on the length: the corpus's
own words from ``LEAST_WORD`` letters say how often ordinary tokens pass. The root of minus the logarithm of p of
words is close to normal, with a mean that is linear in the length; this line is fitted to all words that are shorter
than a length class and gives, with the error of its prediction, what share of ordinary tokens of that class passes a
threshold. Longer classes, where words are few, so have their power from shorter ones. The lowest threshold is taken at
which the passes expected from ordinary tokens are at most ``false_share`` of all (how many tokens are ordinary is
estimated from those far below any threshold). Tokens of letters only, which may be words or secrets, have thresholds
of their own. Each distinct token counts once, so copies of a document or a line common to a source don't move the
thresholds; these come from counts of tokens by length and step, so they don't depend on the order of rows.
Scans happen within the row; for the thresholds, hashes of the distinct long tokens are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import bound, fresh

#: The base kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LEAST_ASSIGNED = 12
TOKEN = "[A-Za-z0-9+/_-]{16,}"
#: Width of the steps of the root of -log p, the thresholds (from about 0.5 to 0.001), and the shortest length of each
#: length class.
STEP = 0.05
STEPS = range(17, 53)
LADDER = tuple(math.exp(-((STEP * k) ** 2)) for k in STEPS)
MOST_STEPS = 200
LENGTHS = (16, 20, 24, 32, 48)
LEAST_WORD = 12
DIGITS, SMALL, LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SPAN = "array<struct<s:int,e:int,x:string>>"
PIECE = 256


def none() -> Column:
    return F.array().cast(SPAN)


def folded(rows: Column, kind: str, add: Callable[[Column, Column], tuple[Column, Column]], at: Column | None = None) -> Column:
    """struct<at, out>: ``add`` gives, from the position so far and a row, the next position and what is appended to
    ``out``, an array of the type ``kind``. Arrays grow in pieces of PIECE rows, so the cost is near to linear."""
    one = f"struct<at:int,out:{kind}>"
    several = f"struct<at:int,out:array<{kind}>>"

    def step(acc: Column, row: Column) -> Column:
        def taken(made: Column) -> Column:
            return F.struct(made["at"].alias("at"), F.concat(acc["out"], made["more"]).alias("out")).cast(one)

        following, more = add(acc["at"], row)
        return bound(F.struct(following.alias("at"), more.cast(kind).alias("more")), taken)

    def piece(acc: Column, part: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("out")).cast(one)
        return bound(F.aggregate(part, start, step), lambda made: F.struct(made["at"].alias("at"), F.concat(acc["out"], F.array(made["out"])).alias("out")).cast(several))

    def whole(every: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(every), F.lit(1)), F.lit(PIECE)), lambda k: F.slice(every, k, F.lit(PIECE)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out")).cast(several)
        return F.aggregate(parts, start, piece, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))

    return bound(rows, whole)


def located(text: Column, found: Column, pattern: str) -> Column:
    """Code point spans of the matches: between them stand the parts that a split at the pattern gives."""
    parts = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, x: F.struct(F.length(g).alias("g"), x.alias("x")))

    def add(at: Column, y: Column) -> tuple[Column, Column]:
        s = at + y["g"]
        e = s + F.length(y["x"])
        return e, F.array(F.struct(s.alias("s"), e.alias("e"), y["x"].alias("x")))

    return F.when(F.size(found) > 0, folded(parts, SPAN, add)["out"]).otherwise(none())


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with each of the sorted spans (s, e), in code points, replaced by its mark; of overlapping ones the
    first counts. A null text counts as empty. The text is cut once into pieces of PIECE code points and what stands
    between spans is put together from these, as finding a place from the start of a text for each span would cost the
    square."""

    def between(pieces: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        some = F.slice(pieces, first + 1, F.floor((b - 1) / PIECE).cast("int") - first + 1)
        return F.when(b > a, F.substr(F.array_join(some, ""), a - first * PIECE + 1, b - a)).otherwise(F.lit(""))

    def whole(pieces: Column) -> Column:
        def add(at: Column, c: Column) -> tuple[Column, Column]:
            parts = F.when(c["s"] >= at, F.array(between(pieces, at, c["s"]), mark(c))).otherwise(F.array().cast("array<string>"))
            return F.greatest(at, c["e"]), parts

        return bound(folded(spans, "array<string>", add), lambda made: F.concat(F.array_join(made["out"], ""), between(pieces, made["at"], F.length(text))))

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0), whole)


def upper_tail(z: Column) -> Column:
    """P(Z >= z) of a standard normal, for z >= 0, to about 1e-7."""
    t = 1 / (1 + 0.2316419 * z)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series, F.lit(1e-14))


def also(rows: Column, make: Callable[[Column], dict[str, Column]], keep: tuple[str, ...]) -> Column:
    """Every struct of an array with further fields."""
    return F.transform(rows, lambda c: F.struct(*[c[k].alias(k) for k in keep], *[v.alias(k) for k, v in make(c).items()]))


def alphabet_of(x: Column) -> Column:
    """The smallest alphabet that a token fits; null for digits alone. Letters alone are ordinary words."""
    return (
        F.when(x.rlike("^[0-9]+$"), F.lit(None))
        .when(x.rlike("^[a-z]+$") | x.rlike("^[A-Z][a-z]*$") | x.rlike("^[A-Z]+$"), F.lit(SMALL))
        .when(x.rlike("^[0-9a-f]+$"), F.lit(DIGITS + "abcdef"))
        .when(x.rlike("^[0-9A-F]+$"), F.lit(DIGITS + "ABCDEF"))
        .when(x.rlike("^[A-Z2-7]+$"), F.lit("234567" + LARGE))
        .when(x.rlike("^[a-z0-9]+$"), F.lit(DIGITS + SMALL))
        .when(x.rlike("^[A-Z0-9]+$"), F.lit(DIGITS + LARGE))
        .when(x.rlike("^[A-Za-z0-9]+$"), F.lit(DIGITS + LARGE + SMALL))
        .otherwise(F.lit("+/" + DIGITS + LARGE + SMALL))
    )


def is_word(x: Column) -> Column:
    return x.rlike("^[a-z]+$") | x.rlike("^[A-Z][a-z]*$") | x.rlike("^[A-Z]+$")


def battery(tokens: Column) -> Column:
    """array<struct<s, e, x, n, p>>: length and joint p-value of each token that has an alphabet."""
    place = ("s", "e", "x")
    a = also(tokens, lambda c: {"abc": alphabet_of(c["x"]), "t": F.when(is_word(c["x"]), F.lower(c["x"])).otherwise(F.translate(c["x"], "-_", "+/"))}, place)
    a = F.filter(a, lambda c: c["abc"].isNotNull())
    half = {k: "0" * (k - k // 2) + "1" * (k // 2) for k in (16, 26, 32, 36, 62, 64)}

    def halves(c: Column) -> Column:
        out = F.lit(None)
        for k, bits in half.items():
            out = F.when(F.length(c["abc"]) == k, F.lit(bits)).otherwise(out)
        return out

    a = also(a, lambda c: {"abc": c["abc"], "t": c["t"], "n": F.length(c["t"]), "k": F.length(c["abc"]), "cs": F.split(c["t"], ""), "h": halves(c)}, place)
    a = also(
        a,
        lambda c: {
            "n": c["n"],
            "k": c["k"],
            "squares": F.aggregate(F.array_distinct(c["cs"]), F.lit(0.0), lambda acc, x: acc + F.pow(c["n"] - F.length(F.replace(c["t"], x, F.lit(""))), F.lit(2.0))),
            "bits": F.array_join(F.transform(c["cs"], lambda x: F.substr(c["h"], F.position(x, c["abc"]), F.lit(1))), ""),
            "vs": F.transform(c["cs"], lambda x: F.position(x, c["abc"]) - 1 - (c["k"] - 1) / 2),
        },
        place,
    )
    a = also(
        a,
        lambda c: {
            "n": c["n"],
            "k": c["k"],
            "x2": c["k"] / c["n"] * c["squares"] - c["n"],
            "n1": F.length(F.replace(c["bits"], F.lit("0"), F.lit(""))),
            "turns": (2 * c["n"] - F.length(F.replace(c["bits"], F.lit("01"), F.lit(""))) - F.length(F.replace(c["bits"], F.lit("10"), F.lit("")))) / 2,
            "serial": F.aggregate(F.zip_with(F.slice(c["vs"], F.lit(1), c["n"] - 1), F.slice(c["vs"], F.lit(2), c["n"] - 1), lambda u, v: u * v), F.lit(0.0), lambda acc, u: acc + u),
        },
        place,
    )

    def scores(c: Column) -> dict[str, Column]:
        n, k = c["n"].cast("double"), c["k"].cast("double")
        df = k - 1
        both = 2.0 * c["n1"] * (n - c["n1"])
        spread = both * (both - n) / (n * n * (n - 1))
        return {
            "n": c["n"],
            "chi": (F.pow(c["x2"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)),
            "runs": F.when(spread > 0, F.abs(c["turns"] + 1 - both / n - 1) / F.sqrt(spread)).otherwise(F.lit(8.0)),
            "corr": F.abs(c["serial"]) / ((k * k - 1) / 12 * F.sqrt(n - 1)),
        }

    a = also(a, scores, place)
    a = also(a, lambda c: {"n": c["n"], "half": -F.log(F.when(c["chi"] >= 0, upper_tail(c["chi"])).otherwise(1 - upper_tail(-c["chi"]))) - F.log(F.least(2 * upper_tail(c["runs"]), F.lit(1.0))) - F.log(F.least(2 * upper_tail(c["corr"]), F.lit(1.0)))}, place)
    # Fisher: minus twice the sum of logs is chi-squared with six degrees of freedom, whose tail has a closed form
    return also(a, lambda c: {"n": c["n"], "p": F.exp(-c["half"]) * (1 + c["half"] + c["half"] * c["half"] / 2)}, place)


def length_class(n: Column) -> Column:
    return sum(((n >= least).cast("int") for least in LENGTHS[1:]), F.lit(0))


def fitted(words: list[tuple[int, int, int]], n: int) -> Callable[[int], float] | None:
    """From (length, step, how many) of words: the share of ordinary tokens of length ``n`` that are below a step; None
    where the words say nothing about it."""
    many = sum(k for *_, k in words)
    if many < 3:
        return None
    mean_n, mean_r = sum(m * k for m, _, k in words) / many, sum((r + 0.5) * k for _, r, k in words) / many
    nn = sum((m - mean_n) ** 2 * k for m, _, k in words)
    nr = sum((m - mean_n) * (r + 0.5 - mean_r) * k for m, r, k in words)
    rr = sum((r + 0.5 - mean_r) ** 2 * k for _, r, k in words)
    left = (rr - nr * nr / nn) / (many - 2) if nn else 0.0
    if left <= 0:
        return None
    spread = math.sqrt(left * (1 + 1 / many + (n - mean_n) ** 2 / nn))
    ordinary = NormalDist(mean_r + nr / nn * (n - mean_n), spread)
    return ordinary.cdf


def thresholds(docs: DataFrame, false_share: float = 0.05, text_col: str = "text") -> list[float]:
    """The threshold of each length class, then those of tokens of letters only; 2 where none is low enough."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN.replace("16", str(LEAST_WORD))), 0)
    found = F.filter(F.array_distinct(found), lambda x: (F.length(x) >= LENGTHS[0]) | is_word(x))
    spans = F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda x: F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"), x.alias("x")))
    tested = docs.select(F.explode(battery(spans)).alias("c"))
    step = F.least(F.floor(F.sqrt(F.greatest(-F.log(F.col("c.p")), F.lit(0.0))) / STEP), F.lit(MOST_STEPS)).cast("int")
    # words by length, as far as one is fitted to; others by class
    n = F.when(is_word(F.col("c.x")), F.least(F.col("c.n"), F.lit(LENGTHS[-1]))).otherwise(F.element_at(F.array(*map(F.lit, LENGTHS)), length_class(F.col("c.n")) + 1))
    by = {"n": n, "word": is_word(F.col("c.x")), "step": step}
    # by hash, so rows of fixed size are shuffled; the others depend on the token only
    distinct = tested.select(F.xxhash64("c.x").alias("h"), *[v.alias(k) for k, v in by.items()]).distinct()
    counts = [(r["word"], r["n"], r["step"], r["count"]) for r in distinct.groupBy(*by).count().orderBy(*by).collect()]

    def chosen(word: bool, k: int) -> float:
        below = fitted([x for is_one, *x in counts if is_one and x[0] < LENGTHS[k]], LENGTHS[k])
        mine = [(r, many) for is_one, n, r, many in counts if is_one == word and LENGTHS[k] <= n < [*LENGTHS, math.inf][k + 1]]
        if below is None or not mine:
            return 2.0
        every = sum(many for _, many in mine)
        passing = {step: sum(many for r, many in mine if r < step) for step in STEPS}
        # Storey's estimate of how many are ordinary: random tokens are seldom below the last step, words often
        ordinary = min(every, (1 + every - passing[STEPS[-1]]) / max(1 - below(STEPS[-1]), 1e-9))
        low = [x for step, x in zip(STEPS, LADDER, strict=True) if passing[step] and below(step) * ordinary <= false_share * passing[step]]
        return min(low, default=2.0)

    return [chosen(word, k) for word in (False, True) for k in range(len(LENGTHS))]


def scan(docs: DataFrame, limits: list[float], text_col: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` and one of a name that they don't have, which is given, too: array<struct<s, o, kind, e>>
    in order, spans of all kinds in code points, end exclusive, o being the number of the kind. A null text has none."""
    mine = {c: fresh(c, docs.columns) for c in ("body", "assigned", "keys", "digits", "tokens", "spans")}
    text, empty = F.coalesce(F.col(text_col), F.lit("")), F.array().cast("array<string>")
    access = F.when(F.contains(text, F.lit("AKIA")), F.regexp_extract_all(text, F.lit(ACCESS), 0)).otherwise(empty)
    found = {"body": text, "assigned": F.regexp_extract_all(text, F.lit(ASSIGN), 0), "keys": access, "digits": F.regexp_extract_all(text, F.lit(HEX), 0), "tokens": F.regexp_extract_all(text, F.lit(TOKEN), 0)}
    with_found = docs.withColumns({mine[k]: v for k, v in found.items()})
    body, ofs, keys, digits, words = (F.col(mine[k]) for k in found)
    value = F.regexp_extract_all(body, F.lit(ASSIGN), 2)
    assigned = F.when(F.size(ofs) > 0, F.filter(F.zip_with(located(body, ofs, ASSIGN), value, lambda c, v: F.struct(c["s"].alias("s"), c["e"].alias("e"), v.alias("x"))), lambda c: F.length(c["x"]) >= LEAST_ASSIGNED)).otherwise(none())
    limits = [*limits, *[2.0] * (2 * len(LENGTHS) - len(limits))]
    limit = F.array(*[F.lit(float(x)) for x in limits])

    def allowed(x: Column) -> Column:
        return F.element_at(limit, length_class(F.length(x)) + F.when(is_word(x), 1 + len(LENGTHS)).otherwise(1))

    def tested(x: Column) -> Column:
        return (allowed(x) <= 1) & ~x.rlike("^[0-9]+$")

    tokens = F.when(F.exists(words, tested), F.filter(located(body, words, TOKEN), lambda c: tested(c["x"]))).otherwise(none())
    random = F.filter(battery(tokens), lambda c: c["p"] >= allowed(c["x"]))

    def named(spans: Column, o: int) -> Column:
        return F.transform(spans, lambda c: F.struct(c["s"].alias("s"), F.lit(o).alias("o"), F.lit(KINDS[o]).alias("kind"), c["e"].alias("e")))

    every = [named(x, o) for o, x in enumerate((assigned, located(body, keys, ACCESS), located(body, digits, HEX), random))]
    return with_found.withColumn(mine["spans"], F.array_sort(F.concat(*every))).drop(*(mine[k] for k in found)), mine["spans"]


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda c: F.concat(c["kind"], F.lit(":"), c["s"].cast("string"), F.lit(":"), c["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame, limits: list[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans. A null text counts as empty, and then
    the strings of spans are empty. Repeated rows give repeated rows, no rows none."""
    limits = thresholds(docs, text_col=text_col) if limits is None else limits
    found, name = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), limits)
    found, spans = found.select("doc_id", name), F.col(name)

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = written(F.filter(spans, lambda c: c["o"] < 3))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"), written(spans).alias("spans"))


def redact(docs: DataFrame, limits: list[float] | None = None, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with every span, overlapping ones joined, replaced by the mark; other rows and columns as they were,
    null texts and repeated rows, too. No rows give none."""
    limits = thresholds(docs, text_col=text_col) if limits is None else limits
    text = F.col(text_col)
    found, name = scan(docs, limits, text_col)
    clean = replaced(text, F.col(name), lambda c: F.lit(mark))
    return found.withColumn(text_col, F.when(F.size(name) > 0, clean).otherwise(text)).drop(name)
