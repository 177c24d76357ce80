"""Personal data by candidate gradient boosting (operator 7).

Only DataFrame and JVM functions. Generators with high recall propose spans, which may overlap: the base
patterns before their checks, loose numbers, loose and spelled-out addresses, account codes. Every
candidate gets features of its format (length, digits, separators, check digit, generator) and of its
context (neighbouring characters, words before it). Boosted trees are trained on half of all
candidates, picked by a hash, where those that overlap a valid base span are positive. Spelled-out
addresses and account codes hardly ever overlap one, so those of a sound form of their own are positive
too: a domain with a known ending, a code whose ISO 13616 check digits hold. These two generators
weigh at least an equal share each in training, however rare they
are. The other half is held back to calibrate, per generator, the least score whose precision
reaches ``PRECISION``. Candidates at or above it that overlap no base span are added, the best of overlapping
ones first by score and place. Base spans always stay.

Fixed values: the base patterns, as given by the task. They are written with possessive repeats and a
look-behind, which changes no match but keeps long runs linear and Java's stack flat.

Defined cases: null text counts as empty; an empty text has no spans; without candidates of both labels
nothing is added, nor from a generator without a positive among the held-back candidates; rows that repeat id and text each get the same result; null ids are kept; extra columns
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.decontamination import once
from daymark.llm.frames import thin
from daymark.session import materialize

# Kinds in their order, the patterns, and the character without which none can match.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "number": r"(?<![A-Za-z0-9])[0-9(][0-9 ()./-]{5,38}[0-9](?![A-Za-z0-9])",
    "address": r"[^\s@]{1,64}+@[^\s@]{3,80}",
    "spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]?(?:at|AT)[)\]] ?[A-Za-z0-9-]{1,60}(?:(?:\.| ?[(\[](?:dot|DOT|\.)[)\]] ?)[A-Za-z0-9-]{1,60}){0,6}?"
               r" ?[(\[]?(?:dot|DOT|\.)[)\]]? ?[A-Za-z]{2,12}(?![A-Za-z0-9-]|\.[A-Za-z0-9]| ?[(\[](?:dot|DOT|\.)[)\]])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}(?![A-Za-z0-9])",
}
NEEDS = {"email": "@", "address": "@", "phone": "+", "ip": ".", "spelled": "(at)"}
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
GENERATORS = (*KINDS, *LOOSE)
# Domain endings of addresses, the generic ones of common use and those of countries.
ENDINGS = """com org net edu gov mil int info biz name pro aero coop museum jobs mobi tel travel cat asia post app dev cloud online site shop tech
ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu
cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id
ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr
ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si
sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw""".split()
SEPARATOR = r"(?:\.| ?[(\[](?:dot|\.)[)\]] ?)"
LABEL = "[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
SOUND_ADDRESS = rf"(?i)[(\[]at[)\]] ?{LABEL}(?:{SEPARATOR}{LABEL})*{SEPARATOR}(?:{'|'.join(ENDINGS)})$"
SOUND = ("spelled", "account")  # generators with positives of a sound form
CUES = ("mail", "contact", "phone", "tel", "call", "card", "account", "ip", "host", "version", "page", "id")
ROUNDS, DEPTH, PRECISION = 10, 3, 0.95
CONTEXT = 24
SPAN = "array<struct<start:int,stop:int,value:string>>"


def located(pieces: Column, hits: Column) -> Column:
    """Matches with their code point offsets, from the pieces between them."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = (acc["at"] + F.length(x["piece"])).cast("int")
        stop = (start + F.length(x["hit"])).cast("int")
        here = F.struct(start.alias("start"), stop.alias("stop"), x["hit"].alias("value"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    both = F.zip_with(hits, F.slice(pieces, 1, F.size(hits)), lambda h, p: F.struct(h.alias("hit"), p.alias("piece")))
    return F.aggregate(both, empty, step, lambda acc: acc["out"])


def gate(name: str) -> Column:
    """Whether a match is possible at all."""
    has_digit = F.col("text").rlike("[0-9]")
    if name == "spelled":
        return F.lower("text").rlike(r"[\])]") & F.lower("text").contains("at")
    need = NEEDS.get(name)
    here = F.col("text").contains(need) if need else F.lit(True)
    return here if name in ("email", "address") else here & has_digit


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = digits(value)
    n = F.length(d)

    def share(i: Column) -> Column:
        digit = F.substr(d, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), share), F.lit(0), lambda a, b: a + b) % 10 == 0


def iban(value: Column) -> Column:
    """Whether the check digits of an account code hold: moved behind the rest, letters as 10 to 35, it is 1 modulo 97."""
    moved = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))
    codes = F.transform(F.sequence(F.lit(1), F.length(moved)), lambda i: F.ascii(F.substr(moved, i, F.lit(1))))
    rest = F.aggregate(codes, F.lit(0), lambda r, c: F.when(c < 58, r * 10 + c - 48).otherwise(r * 100 + c - 55) % 97)
    return rest == 1


def sound(generator: Column, value: Column) -> Column:
    return F.when(generator == "account", iban(value)).when(generator == "spelled", value.rlike(SOUND_ADDRESS)).otherwise(F.lit(False))


def valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "card": F.when((n >= 14) & (n <= 19), luhn(value)).otherwise(F.lit(False)),
        "phone": (n >= 10) & (n <= 15),
    }[kind]


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, text, found): ``found`` has the spans of every generator."""
    rows = thin(docs, id_col, text_col)
    matched = F.struct(*[F.when(gate(g), F.struct(F.split("text", p, -1).alias("pieces"), F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("hits"))).alias(g)
                         for g, p in {**PATTERNS, **LOOSE}.items()])
    cut = once(rows, "m", matched, "doc_id", "text")
    spans = F.struct(*[F.coalesce(located(F.col(f"m.{g}.pieces"), F.col(f"m.{g}.hits")), F.array().cast(SPAN)).alias(g) for g in GENERATORS])
    return once(cut.withColumn("row_key", F.xxhash64("doc_id", "text")), "found", spans, "doc_id", "row_key", "text")


def base_of(found: Column) -> Column:
    """Valid base spans as structs (start, kind_no, stop), in order."""
    def of_kind(i: int, kind: str) -> Column:
        return F.transform(F.filter(found[kind], lambda s: valid(kind, s["value"])),
                           lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind_no"), s["stop"].alias("stop")))

    return F.array_sort(F.concat(*[of_kind(i, k) for i, k in enumerate(KINDS)]))


def written(spans: Column, names: tuple[str, ...]) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, names)), s["kind_no"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["stop"])), ",")


def overlaps(a_start: Column, a_stop: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < a_stop) & (s["stop"] > a_start))


def features(c: DataFrame) -> tuple[DataFrame, list[str]]:
    """Numeric features of candidates (generator, value, before, after)."""
    value, n = F.col("value"), F.length("value")
    n_digits = F.length(digits(value))
    columns = {
        "length": n, "n_digits": n_digits, "digit_share": n_digits / n, "letters": F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "dots": F.length(F.regexp_replace(value, r"[^.]", "")), "spaces": F.length(F.regexp_replace(value, r"[^ -]", "")),
        "parts": F.size(F.split(value, r"[^0-9A-Za-z]+")), "plus": value.startswith("+") | F.col("before").endswith("+"), "at": value.contains("@"),
        "sound": sound(F.col("generator"), value), "check_digit": F.when(n_digits.between(12, 19), luhn(value)).otherwise(F.lit(False)), "small_parts": value.rlike(rf"^{PART}(?:\.{PART})+$"),
        "word_before": F.col("before").rlike(r"[A-Za-z0-9]$"), "word_after": F.col("after").rlike("^[A-Za-z0-9]"),
        "assigned": F.col("before").rlike(r"""[:=]["' ]*$"""), "quoted": F.col("after").rlike("""^["']"""),
    }
    columns |= {f"is_{g}": F.col("generator") == g for g in GENERATORS}
    columns |= {f"cue_{w}": F.lower("before").contains(w) for w in CUES}
    named = c.select("*", *[v.cast("double").alias(f"x_{k}") for k, v in columns.items()])
    return named.fillna(0.0, [f"x_{k}" for k in columns]), [f"x_{k}" for k in columns]


def candidates(found: DataFrame) -> DataFrame:
    """One row per proposed span, with its context, whether it overlaps a valid base span (``in_base``) and its label."""
    def of_generator(g: str) -> Column:
        return F.transform(F.col("found")[g], lambda s: F.struct(F.lit(g).alias("generator"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))

    listed = F.concat(*map(of_generator, GENERATORS))
    text = F.col("text")
    around = F.transform(listed, lambda s: F.struct(
        s["generator"].alias("generator"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"),
        F.substr(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))).alias("before"),
        F.substr(text, s["stop"] + 1, F.lit(2)).alias("after")))
    rows = once(found, "around", around, "row_key", "base").where(F.size("around") > 0)
    listed = rows.select("row_key", "base", F.explode("around").alias("c")).select(
        "row_key", "c.*", overlaps(F.col("c.start"), F.col("c.stop"), F.col("base")).alias("in_base")).distinct()
    return listed.withColumn("label", (F.col("in_base") | sound(F.col("generator"), F.col("value"))).cast("double"))


def chosen(c: DataFrame) -> DataFrame | None:
    """Action: candidates outside base spans that reach their generator's calibrated score; None without a model."""
    counts = dict(c.groupBy("generator").count().collect())
    weights = {g: max(1.0, sum(counts.values()) / len(GENERATORS) / counts[g]) for g in SOUND if g in counts}
    weight = reduce(lambda rest, g: F.when(F.col("generator") == g, weights[g]).otherwise(rest), weights, F.lit(1.0))
    place = F.pmod(F.xxhash64("row_key", "generator", "start"), F.lit(1 << 20))
    named, names = features(c.withColumn("place", place).withColumn("weight", weight))
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(named)
    ready = materialize(assembled.select("row_key", "generator", "start", "stop", "in_base", "label", "weight", "features", "place"), "candidates")
    train = ready.where("place % 2 = 0")
    if train.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False).fit(train)
    scored = lambda df: model.transform(df).withColumn("score", F.round(vector_to_array("probability")[1], 3))
    by_score = scored(ready.where("place % 2 = 1")).groupBy("generator", "score").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"))
    ahead = by_score.alias("a").join(by_score.alias("b"), (F.col("a.generator") == F.col("b.generator")) & (F.col("b.score") >= F.col("a.score")))
    # Scores are rounded to a thousandth, so a generator has 1,001 rows at most.
    cutoffs = (ahead.groupBy(F.col("a.generator").alias("generator"), F.col("a.score").alias("cutoff"))
               .agg((F.sum("b.good") / F.sum("b.n")).alias("precision")).where(F.col("precision") >= PRECISION)
               .groupBy("generator").agg(F.min("cutoff").alias("cutoff")))
    more = scored(ready.where("not in_base")).join(F.broadcast(cutoffs), "generator")  # one row per generator
    return more.where(F.col("score") >= F.col("cutoff")).select("row_key", "generator", "start", "stop", "score")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Action: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row."""
    found = proposals(docs, id_col, text_col)
    found = once(found, "base", base_of(F.col("found")), "doc_id", "row_key", "text", "found")
    listed = materialize(candidates(found), "proposals")
    base = found.select("doc_id", "row_key", "base")
    picked = chosen(listed)
    names = (*KINDS, *LOOSE)
    added = F.array().cast("array<struct<start:int,kind_no:int,stop:int>>")
    if picked is not None:
        number = reduce(lambda rest, x: F.when(F.col("generator") == x[1], x[0]).otherwise(rest), list(enumerate(names)), F.lit(0))
        ranked = F.struct((-F.col("score")).alias("worst"), F.col("start"), number.alias("kind_no"), F.col("stop"))
        per_row = picked.groupBy("row_key").agg(F.array_sort(F.collect_set(ranked)).alias("picked"))  # bounded by one text's spans
        best = F.aggregate("picked", added, lambda acc, s: F.when(overlaps(s["start"], s["stop"], acc), acc).otherwise(
            F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["stop"].alias("stop"))))))
        base = base.join(per_row.select("row_key", best.alias("more")), "row_key", "left")
        added = F.coalesce(F.col("more"), added)
    def count_of(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind_no"] == i)).cast("bigint")

    counts = [count_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return base.select("doc_id", *counts, F.sha2(written(F.col("base"), names), 256).alias("base_sha256"),
                       written(F.array_sort(F.concat("base", added)), names).alias("spans"))
