"""Secret scan: three fixed patterns, then the ratio of two character models. DataFrame functions only.

The patterns find assigned, access and hex secrets, leftmost and without overlap for each kind. The
method adds runs of at least ``RUN`` characters from ``[A-Za-z0-9+/_=-]`` that overlap none of those and look random: a Markov
model of random strings and one of ordinary identifiers give each character a probability after the two before it,
interpolated with shorter contexts, and a run is reported when its mean log-likelihood ratio reaches a threshold.

Both models are trained from labelled strings of all documents. Random ones are the values that the patterns
found, and ``MADE`` strings for each of four alphabets that are random by construction (hashes), since a corpus may lack
an alphabet. Ordinary ones are words and names of eight characters or more made of letters, separators and up to four
closing digits, and plain numbers; each distinct one also counts once as a longer identifier made of it twice, and so does
every character repeated as in a ruled line. On a fifth of the other strings, which the counts leave out, the threshold is set
three standard deviations below the mean score of the made random strings (those of the corpus may be of one alphabet),
or between the classes where they are closer.

The alphabet has 67 characters and two marks, so a model has at most 69 ** 3 rows whatever the input; that bound is what
allows it to be broadcast. Positions are counted in code points: the text is split at the matches, and
lengths of gaps and matches are summed within the document. Only the spans of a document meet in one task, never
those of many.

Null counts as empty. Repeated rows and rows without an id are scanned each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.llm.common import written

# Kinds of secrets, their patterns and least lengths.
_VALUE = "[A-Za-z0-9+/_.=-]+"
_NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = "(" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in _NAMES) + f""")["']?\\x20*[:=]\\x20*["']?({_VALUE})"""
KINDS = (("assign", ASSIGN, 8), ("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32))

RUN = 20
CANDIDATE = ("random", "[A-Za-z0-9+/_=-]{%d,}" % RUN, RUN)
#: Behind a short match of the last two patterns no longer one can start, so the least length may go into
#: the pattern; it keeps the short runs of hex digits in words from being listed.
SEARCHED = (ASSIGN, "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}", CANDIDATE[1])
ORDINARY = "(?<![A-Za-z0-9+/_=.-])(?:[A-Za-z_/.-]{8,}+[0-9]{0,4}+|[A-Z]{0,4}+[0-9]{6,}+)(?![A-Za-z0-9+/_=-])"
MADE = 4096
CONTEXT = 2
START, END, OTHER = "^", "$", "."
SIZE = 69


def found(docs: DataFrame) -> DataFrame:
    """A written row per document: row, doc_id, and per kind its matches, each with the text before it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    hits = texts.select("*", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"h{k}")
                               for k, p in enumerate(SEARCHED)))
    parts = [F.when(F.size(f"h{k}") > 0, F.arrays_zip(
        F.split("text", p, -1).alias("gap"), F.col(f"h{k}").alias("hit"))).alias(f"k{k}") for k, p in enumerate(SEARCHED)]
    return written(hits.select("row", "doc_id", *parts), "matches")


def spans(matches: DataFrame) -> DataFrame:
    """A written row per span: row, kind (its number), start, end, hit, value. Of the candidates only those
    that overlap no span of the fixed kinds."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"k{k}").alias("parts")) for k in range(len(SEARCHED))))
    each = matches.select("row", F.explode(kinds).alias("of")).where("of.parts is not null")
    placed = each.select("row", F.col("of.kind").alias("kind"), F.posexplode("of.parts").alias("at", "part")).where(
        "part.hit is not null").select("row", "kind", "at", F.length("part.gap").alias("gap"), F.col("part.hit").alias("hit"))
    placed = placed.repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.length("hit")).cast("long")).over(order)
    value = F.when(F.col("kind") == 0, F.regexp_extract("hit", ASSIGN, 2)).otherwise(F.col("hit"))
    least = F.element_at(F.array(*(F.lit(n) for *_, n in (*KINDS, CANDIDATE))), F.col("kind") + 1)
    kept = placed.withColumn("end", end).withColumn("value", value).where(F.length("value") >= least).select(
        "row", "kind", (F.col("end") - F.length("hit")).alias("start"), "end", "hit", "value")
    # A candidate overlaps a fixed span that starts before it and ends behind its start, or the next one to start.
    fixed = F.col("kind") < len(KINDS)
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    reach = kept.withColumn("last_end", F.max(F.when(fixed, F.col("end"))).over(before)).withColumn(
        "next_start", F.min(F.when(fixed, F.col("start"))).over(after))
    free = (F.coalesce("last_end", F.lit(0)) <= F.col("start")) & (
        F.col("next_start").isNull() | (F.col("next_start") >= F.col("end")))
    return written(reach.where(fixed | free).drop("last_end", "next_start"), "spans")


def made_strings(spark: SparkSession, count: int = MADE) -> DataFrame:
    """(text, n): ``count`` strings that are random by construction for each of four alphabets."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    hexes = F.substring(digest, 1, 40)
    coded = F.base64(F.unhex(digest))
    upper = F.upper(F.translate(coded, "+/=", ""))
    kinds = F.array(hexes, F.upper(hexes), coded, F.substring(upper, 1, 32))
    return spark.range(count).select(F.explode(kinds).alias("text"), F.lit(1).cast("long").alias("n"))


def joined(names: DataFrame) -> DataFrame:
    """(text, n): each name as an identifier of two parts, with a separator or a change of case picked by hash."""
    name = F.col("text")
    ways = F.array(*(F.concat(name, F.lit(c), name) for c in "_-/=+"), F.concat(F.initcap(name), F.initcap(name)),
                   F.concat(F.lower(name), F.initcap(name)), F.concat_ws("_", F.upper(name), F.upper(name)))
    return names.select(F.element_at(ways, (F.crc32("text") / 5 % 8).cast("int") + 1).alias("text"),
                        F.lit(1).cast("long").alias("n"))


def ruled_lines(spark: SparkSession, count: int = 64) -> DataFrame:
    """(text, n): every character of runs repeated, ``count`` times each."""
    every = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
    return spark.range(1).select(F.explode(F.split(F.lit(every), "")).alias("c")).select(
        F.repeat("c", F.lit(32)).alias("text"), F.lit(count).cast("long").alias("n"))


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """A written row per string and source: text, random and ordinary (its counts), made, held (left out of the counts)."""
    hits = known.where(F.col("kind") < len(KINDS)).groupBy(F.col("value").alias("text")).agg(
        F.count(F.lit(1)).alias("n"))
    names = docs.select(F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(ORDINARY), F.lit(0))).alias(
        "text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    names = written(names, "names")
    names = names.unionByName(joined(names))
    none = F.lit(0).cast("long")
    no, yes = F.lit(False).alias("made"), F.lit(True).alias("made")
    both = hits.select("text", "n", no).unionByName(made_strings(docs.sparkSession).select("text", "n", yes)).select(
        "text", F.col("n").alias("random"), none.alias("ordinary"), "made").unionByName(
        names.select("text", none.alias("random"), F.col("n").alias("ordinary"), no))
    lines = ruled_lines(docs.sparkSession).select("text", none.alias("random"), F.col("n").alias("ordinary"), no)
    both = both.where("text <> ''").withColumn("held", F.crc32("text") % 5 == 0).unionByName(
        lines.withColumn("held", F.lit(False)))
    return written(both, "labelled")


def symbols(text: Column) -> Column:
    """The text in the model's alphabet between marks."""
    return F.concat(F.lit(START * CONTEXT), F.regexp_replace(text, "[^A-Za-z0-9+/_=-]", OTHER), F.lit(END))


def grams(frame: DataFrame, text: str, *keep: str) -> DataFrame:
    """A row per character: ``gram`` holds the two before it and itself."""
    coded = frame.select(*keep, symbols(F.col(text)).alias("symbols"))
    places = F.sequence(F.lit(1), F.length("symbols") - CONTEXT)
    return coded.select(*keep, "symbols", F.explode(places).alias("at")).select(
        *keep, F.substring(F.col("symbols"), F.col("at"), F.lit(CONTEXT + 1)).alias("gram"))


def _probability(count: str, total: float, strength: float) -> Column:
    """Of the last symbol of ``gram`` after the ones before it, interpolated over the lengths of context."""
    last = F.substring("gram", CONTEXT + 1, 1)
    p = (F.sum(count).over(Window.partitionBy(last)) + strength / SIZE) / (total + strength)
    for order in range(1, CONTEXT + 1):
        start = CONTEXT + 1 - order
        seen = F.sum(count).over(Window.partitionBy(F.substring("gram", start, order + 1)))
        context = F.sum(count).over(Window.partitionBy(F.substring("gram", start, order)))
        p = (seen + strength * p) / (context + strength)
    return p


def fit(strings: DataFrame, candidates: DataFrame, strength: float = 2.0) -> DataFrame:
    """A written model (gram, ratio) for all grams of ``strings`` and ``candidates``; ratio in millionths."""
    weighed = strings.select(
        "text", F.when(F.col("held"), 0).otherwise(F.col("random")).alias("random"),
        F.when(F.col("held"), 0).otherwise(F.col("ordinary")).alias("ordinary"))
    none = F.lit(0).cast("long")
    every = weighed.unionByName(candidates.select(F.col("hit").alias("text"), none.alias("random"), none.alias("ordinary")))
    counts = written(grams(every, "text", "random", "ordinary").groupBy("gram").agg(
        F.sum("random").alias("random"), F.sum("ordinary").alias("ordinary")), "grams")
    totals = counts.agg(F.sum("random"), F.sum("ordinary")).first()
    ratio = F.log(_probability("random", float(totals[0] or 0), strength)) - F.log(
        _probability("ordinary", float(totals[1] or 0), strength))
    return written(counts.select("gram", F.round(ratio * 1_000_000).cast("long").alias("ratio")), "secret-model")


def scored(frame: DataFrame, text: str, model: DataFrame, *keep: str) -> DataFrame:
    """``keep``, which must tell rows apart, and ``score``: the mean ratio per character."""
    # At most 69 ** 3 short rows are broadcast; sums of whole numbers do not depend on their order.
    hit = grams(frame, text, *keep).join(F.broadcast(model), "gram")
    return hit.groupBy(*keep).agg((F.sum("ratio") / F.count(F.lit(1)) / 1_000_000).alias("score"))


def threshold(strings: DataFrame, model: DataFrame) -> float:
    """From the scores of the distinct strings held back; zero without both classes."""
    held = strings.where("held").groupBy("text").agg(F.max("made").alias("made"), (F.sum("ordinary") > 0).alias("name"))
    rated = scored(held, "text", model, "text", "made", "name")
    found = rated.agg(*(of(F.when(F.col(kind), F.col("score"))).alias(f"{title}_{kind}") for kind in ("made", "name")
                        for title, of in (("mean", F.avg), ("sd", F.stddev_pop)))).first()
    r, sr, o, so = found
    if r is None or o is None:
        return 0.0
    between = (r * so + o * sr) / (sr + so) if sr + so > 0 else (r + o) / 2
    return round(max(r - 3 * sr, between), 6)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, secrets (array of kind, start, end, by start and kind; end is exclusive)."""
    matches = found(docs)
    known = spans(matches)
    candidates = known.where(F.col("kind") == len(KINDS))
    strings = labelled(docs, known)
    model = fit(strings, candidates)
    least = threshold(strings, model)
    random = scored(candidates, "hit", model, "row", "kind", "start", "end").where(F.col("score") >= least)
    kept = known.where(F.col("kind") < len(KINDS)).select("row", "kind", "start", "end").unionByName(random.drop("score"))
    names = F.array(*(F.lit(name) for name, *_ in (*KINDS, CANDIDATE)))
    listed = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("of"))
    listed = listed.select("row", F.transform("of", lambda s: F.struct(
        F.element_at(names, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("secrets"))
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return matches.select("row", "doc_id").join(listed, "row", "left").select(
        "doc_id", F.coalesce("secrets", nothing).alias("secrets"))


def as_text(secrets: Column | str) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
