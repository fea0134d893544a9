"""Secret scan: fixed patterns, and a randomness test battery for the rest.

The three base kinds are found by pattern.  Other candidates are runs of
``LEAST``+ characters of the usual encodings.  For each, the narrowest encoding
that holds all its characters is inferred and its symbols are tested for
uniform randomness in it: chi-squared on the counts of single symbols and of
groups of symbols (vowels, other letters by case, digits, marks), Wald-Wolfowitz
runs about the middle of the alphabet, and lag-one serial correlation.  The
four p values are combined by Fisher's rule.

False discoveries are ordinary strings among those reported.  Candidates are
put in classes by encoding and length, because short strings have less power.
How p values of truly random strings of a class are distributed is known: the
battery is run once on ``DRAWS`` generated strings of each class.  The number
of random strings in a class is bounded by what is found at high p values,
where ordinary text is rare; what a class holds at lower p values beyond that
number is ordinary.  A class reports all candidates from the lowest p value
where the ordinary ones are estimated to be at most ``RATE`` of those reported
(within two standard deviations of what was counted, and one string).  They are added
as kind ``random``, unless a base span covers part of them.

All of it is DataFrame functions on the row itself: the only data that leave
a row are counts of p values in fixed bins, and what comes back is one
threshold a class.  A text of many spans costs a binary search for each.  Spans are in code points, ends exclusive.

Defined cases: a null or empty text has no spans; rows with null or repeated
ids are scanned each on their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

# Fixed values of the contract.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_CHARS = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

LEAST = 12
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: (name, pattern, symbols) of the encodings, narrowest first.
ENCODINGS = [("decimal", r"^[0-9]+$", 10), ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 16),
             ("letters", r"^([a-z]+|[A-Z]+)$", 26), ("base32", r"^[A-Z2-7]+=*$", 32),
             ("base64", r"", 64)]
LENGTH_CLASSES = [16, 20, 24, 32, 48, 64, 128]
LONGEST_DRAWN = 192  # the last class is open; its strings are drawn up to this length
DRAWS = 500  # generated strings of each encoding and length class
RATE = 0.2  # ordinary strings among those reported
SEEN = 0.2  # random strings are counted where at least this share of them lies
BINS, BIN_STEP = 120, 0.1  # of -log10 p
BLOCK = 512


def _prefix(lens: Column) -> Column:
    """(gap, len) pairs -> (start, end) of each match, in blocks, so that a
    text with very many matches costs no quadratic copying."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def walk(pairs: Column) -> Column:
        def step(acc, x):
            start = acc["at"] + x["gap"]
            return F.struct((start + x["len"]).alias("at"), F.concat(acc["out"], F.array(
                F.struct(start.alias("start"), (start + x["len"]).alias("end")))).alias("out"))

        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step)

    n = F.size(lens)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                         lambda b: walk(F.slice(lens, b * BLOCK + 1, BLOCK)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("out"))

    def add(acc, b):
        moved = F.transform(b["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"),
                                                         (s["end"] + acc["at"]).alias("end")))
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    return F.when(n > 0, F.flatten(F.aggregate(blocks, start, add)["out"])).otherwise(none)


def _find(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: (start, end, text) of the leftmost non-overlapping
    matches, found as the matches and the pieces between them."""
    found, spans = f"_{name}_m", f"_{name}_s"
    df = df.withColumn(found, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
    pieces = F.when(F.size(found) > 0, F.split("_t", pattern, -1)).otherwise(F.array().cast("array<string>"))
    lens = F.zip_with(F.slice(pieces, 1, F.greatest(F.size(found), F.lit(1))), found,
                      lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len")))
    df = df.withColumn(f"_{name}_l", F.when(F.size(found) > 0, lens).otherwise(
        F.array().cast("array<struct<gap:int,len:int>>")))
    df = df.withColumn(spans, _prefix(F.col(f"_{name}_l")))
    return df.withColumn(name, F.zip_with(spans, found, lambda s, m: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), m.alias("text")))).drop(found, spans, f"_{name}_l")


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, Page's logistic form."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def _symbols(codes: Column, kind: Column) -> Column:
    """Alphabet places of ASCII codes for the inferred encoding."""
    def place(c):
        digit, upper, lower = c.between(48, 57), c.between(65, 90), c.between(97, 122)
        return (F.when(kind.isin("decimal", "hex"), F.when(digit, c - 48).when(upper, c - 55).otherwise(c - 87))
                .when(kind == "letters", F.when(upper, c - 65).otherwise(c - 97))
                .when(kind == "base32", F.when(upper, c - 65).otherwise(c - 24))
                .otherwise(F.when(upper, c - 65).when(lower, c - 71).when(digit, c + 4)
                           .when(c.isin(43, 45), F.lit(62)).otherwise(F.lit(63))))

    return F.transform(codes, place)


def battery(token: Column) -> Column:
    """Struct of encoding, length and combined p value of one token."""
    body = F.rtrim(token, F.lit("="))
    kind = F.lit("base64")
    size = F.lit(64)
    for name, pattern, symbols in reversed(ENCODINGS[:-1]):
        kind = F.when(body.rlike(pattern), name).otherwise(kind)
        size = F.when(body.rlike(pattern), symbols).otherwise(size)
    return F.struct(body.alias("body"), kind.alias("kind"), size.alias("size"))


def combined_p(item: Column) -> Column:
    """Fisher's combination of the three tests for one ``battery`` struct."""
    n = F.greatest(F.length(item["body"]), F.lit(3)).cast("double")
    x = _symbols(F.transform(F.split(item["body"], ""), lambda c: F.ascii(c)), item["kind"])
    return _bound(x, lambda x: _tests(x, n, item["size"].cast("double"), item["kind"]))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: a plain expression would
    be worked out again at each place, and for each element inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _grouped(x: Column, n: Column, kind: Column) -> Column:
    """z of the chi-squared test on groups of symbols."""
    def vowel(v, first):
        return v.isin(*[first + i for i in (0, 4, 8, 14, 20)])

    def group(v):
        return (F.when(kind == "base64", F.when(v >= 62, 4).when(v >= 52, 3).when(vowel(v, 0) | vowel(v, 26), 2)
                       .when(v >= 26, 1).otherwise(0))
                .when(kind == "base32", F.when(v >= 26, 2).when(vowel(v, 0), 1).otherwise(0))
                .when(kind == "letters", F.when(vowel(v, 0), 1).otherwise(0))
                .when(kind == "hex", F.when(v >= 10, 1).otherwise(0)).otherwise(F.when(v >= 5, 1).otherwise(0)))

    sizes = {"base64": [21, 21, 10, 10, 2], "base32": [21, 5, 6], "letters": [21, 5], "hex": [10, 6], "decimal": [5, 5]}
    shares = F.array(*[F.lit(c / 10) for c in sizes["decimal"]])
    for name in ("base64", "base32", "letters", "hex"):
        shares = F.when(kind == name, F.array(*[F.lit(c / sum(sizes[name])) for c in sizes[name]])).otherwise(shares)
    groups = F.transform(x, group)
    def z(v):
        chi = F.aggregate(F.transform(v["shares"], lambda s, i: F.pow(
            F.size(F.filter(v["groups"], lambda g: g == i)) - n * s, F.lit(2.0)) / (n * s)),
            F.lit(0.0), lambda a, c: a + c)
        df = (F.size(v["shares"]) - 1).cast("double")
        return (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))

    return _bound(F.struct(groups.alias("groups"), shares.alias("shares")), z)


def _tests(x: Column, n: Column, size: Column, kind: Column) -> Column:
    def pairs(values, f):
        rest = F.greatest(F.size(values) - 1, F.lit(1))
        return F.zip_with(F.slice(values, 1, rest), F.slice(values, 2, rest), f)

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def sums(v):
        square = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda a, s: a + F.pow(
            F.size(F.filter(x, lambda y: y == s)).cast("double"), F.lit(2.0)))
        return F.struct(
            square.alias("square"),
            F.size(F.filter(v["high"], lambda b: b)).cast("double").alias("n1"),
            F.size(F.filter(pairs(v["high"], lambda a, b: a != b), lambda d: d)).cast("double").alias("turns"),
            total(F.transform(x, lambda y: (y - v["mean"]) * (y - v["mean"]))).alias("power"),
            total(pairs(x, lambda a, b: (a - v["mean"]) * (b - v["mean"]))).alias("lag"))

    def log_p(v):
        df = size - 1
        chi = F.greatest(size / n * v["square"] - n, F.lit(0.0))
        z_chi = (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        mean_runs = 2 * v["n1"] * (n - v["n1"]) / n + 1
        spread = F.sqrt((mean_runs - 1) * (mean_runs - 2) / (n - 1))
        z_runs = F.when(spread > 0, (v["turns"] + 1 - mean_runs) / spread).otherwise(F.lit(-8.0))
        z_lag = F.when(v["power"] > 0, (v["lag"] / v["power"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(8.0))
        return _bound(F.struct(z_chi.alias("c"), _grouped(x, n, kind).alias("g"), z_runs.alias("r"), z_lag.alias("l")),
                      lambda z: F.log(_upper_tail(z["c"])) + F.log(_upper_tail(z["g"]))
                      + F.log(_two_sided(z["r"])) + F.log(_two_sided(z["l"])))

    facts = _bound(F.struct(F.transform(x, lambda v: v * 2 >= size).alias("high"), (total(x) / n).alias("mean")), sums)
    return _bound(_bound(facts, log_p), lambda q: F.least(F.lit(1.0), F.exp(q) * (1 - q + q * q / 2 - q * q * q / 6)))


def length_class(n: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES))
    for i in reversed(range(len(LENGTH_CLASSES))):
        out = F.when(n < LENGTH_CLASSES[i], i).otherwise(out)
    return out


def class_of(kind: Column, n: Column) -> Column:
    """Number of the class of an encoding and a length."""
    place = F.lit(0)
    for i, (name, _, _) in enumerate(ENCODINGS):
        place = F.when(kind == name, i).otherwise(place)
    return place * (len(LENGTH_CLASSES) + 1) + length_class(n)


def random_bins(spark) -> DataFrame:
    """(cls, b, n): the bins of ``DRAWS`` random strings of every class, drawn
    by hashes, so the same in every run."""
    lows, highs = [LEAST, *LENGTH_CLASSES], [*LENGTH_CLASSES, LONGEST_DRAWN]
    rows = spark.range(len(ENCODINGS) * len(lows) * DRAWS, numPartitions=len(ENCODINGS))
    cls, draw = F.floor(F.col("id") / DRAWS).cast("int"), (F.col("id") % DRAWS).cast("int")
    part = cls % len(lows)
    low, high = F.array(*[F.lit(v) for v in lows])[part], F.array(*[F.lit(v) for v in highs])[part]
    enc = F.floor(cls / len(lows)).cast("int")
    rows = rows.select("id", cls.alias("cls"), (low + draw % (high - low)).alias("n"),
                       F.array(*[F.lit(e[0]) for e in ENCODINGS])[enc].alias("kind"),
                       F.array(*[F.lit(e[2]) for e in ENCODINGS])[enc].alias("size"))
    x = F.transform(F.sequence(F.lit(1), F.col("n")),
                    lambda i: F.pmod(F.xxhash64(F.col("id"), i), F.col("size").cast("long")).cast("int"))
    p = _bound(x, lambda x: _tests(x, F.col("n").cast("double"), F.col("size").cast("double"), F.col("kind")))
    return rows.select("cls", _bin(p).alias("b")).groupBy("cls", "b").agg(F.count(F.lit(1)).alias("n"))


def _touched(c: Column, spans: Column) -> Column:
    """Whether ``c`` shares a character with one of ``spans``, which are in
    order and apart: the first that ends after the start of ``c`` is found by
    halving."""
    steps = F.sequence(F.lit(0), F.floor(F.log2(F.size(spans) + 1.0)).cast("int"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        left = F.get(spans, mid)["end"] <= c["start"]
        more = s["lo"] < s["hi"]
        return F.struct(F.when(more & left, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(more & ~left, mid).otherwise(s["hi"]).alias("hi"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve)["lo"]
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, found)["start"] < c["end"], F.lit(False))


def _labelled(spans: Column, order: int, kind: str) -> Column:
    """Spans that sort by start, then by the order of their kind."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"),
                                                 s["end"].alias("end"), F.lit(kind).alias("kind")))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, other): base spans with kinds, and the tested candidates
    that no base span touches.  Written once; texts stay behind."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("other", CANDIDATE)):
        df = _find(df, name, pattern)
    value = F.regexp_extract_all("_t", F.lit(ASSIGN), F.lit(2))
    long = F.filter(F.zip_with("assign", value, lambda a, v: F.struct(a.alias("a"), F.length(v).alias("n"))),
                    lambda s: s["n"] >= ASSIGN_CHARS)
    kinds = [_labelled(F.transform(long, lambda s: s["a"]), 0, "assign"),
             _labelled(F.col("access"), 1, "access"), _labelled(F.col("hex"), 2, "hex")]
    assigned = F.transform(long, lambda s: s["a"])
    free = _bound(F.struct(assigned.alias("a"), F.col("access").alias("k"), F.col("hex").alias("h")),
                  lambda o: F.filter("other", lambda c: ~(_touched(c, o["a"]) | _touched(c, o["k"])
                                                          | _touched(c, o["h"]))))
    tested = F.transform(F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                                                              battery(c["text"]).alias("t"))),
                         lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"),
                                            class_of(c["t"]["kind"], F.length(c["t"]["body"])).alias("cls"),
                                            combined_p(c["t"]).alias("p")))
    return saved(df.select("doc_id", F.sort_array(F.concat(*kinds)).alias("base"), tested.alias("other")))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) / BIN_STEP), F.lit(BINS)).cast("int")


def thresholds(rows: DataFrame, rate: float = RATE) -> DataFrame:
    """One row: ``cut``, a map from class to the first bin that is not
    reported.  With R(b) candidates and the share F(b) of random strings in
    the bins up to ``b``, a class holds at most M = min (R(b) + 2 sqrt R(b) + 1)
    / F(b) random strings, over the bins with F(b) >= ``SEEN`` (two standard
    deviations of a count are allowed for); it reports up to the last bin with
    R(b) - M F(b) <= rate R(b)."""
    count = F.count(F.lit(1)).alias("n")
    found = rows.select(F.explode("other").alias("c")).groupBy(F.col("c.cls").alias("cls"), _bin(F.col("c.p")).alias("b"))
    # at most classes x bins rows on either side
    both = found.agg(count).select("cls", "b", "n", F.lit(0.0).alias("f")).unionByName(
        random_bins(rows.sparkSession).select("cls", "b", F.lit(0).cast("long").alias("n"),
                                              (F.col("n") / DRAWS).alias("f")))
    steps = Window.partitionBy("cls").orderBy("b")
    sums = both.groupBy("cls", "b").agg(F.sum("n").alias("n"), F.sum("f").alias("f")).select(
        "cls", "b", F.sum("n").over(steps).alias("r"), F.sum("f").over(steps).alias("f"))
    most = F.min(F.when(F.col("f") >= SEEN, (F.col("r") + 2 * F.sqrt("r") + 1) / F.col("f"))).over(Window.partitionBy("cls"))
    good = sums.withColumn("m", most).where(F.col("r") - F.col("m") * F.col("f") <= rate * F.col("r"))
    last = good.groupBy("cls").agg((F.max("b") + 1).alias("b"))
    return last.agg(F.map_from_entries(F.collect_list(F.struct("cls", "b"))).alias("cut"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_randomness(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Counts and spans of every row."""
    rows = scanned(docs)
    limit = thresholds(rows, rate)
    random = _labelled(F.filter("other", lambda c: _bin(c["p"]) < F.coalesce(F.try_element_at("cut", c["cls"]),
                                                                               F.lit(0))), 3, "random")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{kind}")

    out = rows.crossJoin(F.broadcast(limit))  # the thresholds are one row
    return out.select("doc_id", count("assign"), count("access"), count("hex"),
                      F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _text(F.sort_array(F.concat("base", random))).alias("spans"))
