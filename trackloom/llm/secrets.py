r"""Secret scans: fixed patterns, and a likelihood ratio of two character Markov models, in DataFrame operations alone.

A token of a text (a run of characters that keys are made of) is likelier a random string than an ordinary identifier if
the mean log ratio of its character transitions under the two models is over a threshold. Both models are
counts of transitions in labelled samples, and the threshold is set on the samples as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import text_of

# The base patterns, (kind, pattern, least characters, of which group).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{16,})"
KINDS = [("assign", ASSIGN, 12), ("access", ACCESS, 18), ("hex", HEX, 16)]

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
N = len(ALPHABET)
LEAST_TOKEN = 12
_KEY = "[A-Za-z0-9+/_=-]"
#: Whole runs of key characters, from the shortest value that the base patterns count.
TOKEN = rf"(?<!{_KEY})({_KEY}{{{LEAST_TOKEN},}}+)"

# Parts of ordinary identifiers.
PARTS = (
    "account action address admin alpha android angle answer api apply area array article async attribute author auto backup "
    "balance base batch before binary block body border bottom branch bridge buffer build button cache call camera cancel card cell center chain "
    "change channel char chart check child city class clean clear click client clock close cloud code color column command comment "
    "commit common company compare complete config connect console contact container content context control copy core count country create "
    "current custom data database date debug default delete demo deploy design detail device dialog digest direct display document domain "
    "download draft driver edit element email enable encode energy engine entry error event example export external factory feature field "
    "file filter final first flag folder font footer form format frame function gateway general global graph group handler header "
    "health height hidden history home host hour html icon image import index info initial input insert install internal invoice item"
).split()
# Long words of prose in the four languages of the texts.
WORDS = (
    "administration approximately characteristics circumstances communication comprehensive concentration congratulations consciousness consequently considerable "
    "consideration constitutional construction contemporary contribution conversation demonstrated development disappointment distinguished documentation entertainment "
    "environmental establishment extraordinary identification immediately implementation independence infrastructure installation institutional intellectual "
    "international interpretation introduction investigation manufacturing mathematical neighbourhood nevertheless occasionally organization participation particularly "
    "performance philosophical photographs possibilities professional recommendation relationship representative responsibility revolutionary significantly "
    "simultaneously specification straightforward sustainability technological transformation transportation understanding unfortunately vulnerability "
    "abgeschlossen allerdings arbeitnehmer aufmerksamkeit ausgezeichnet beispielsweise bundesrepublik durchschnittlich einschliesslich entscheidung entwicklung "
    "erfahrungen forschungsergebnisse freundschaft geschwindigkeit gesellschaft gewerkschaften grundsatzlich hauptbahnhof krankenversicherung landwirtschaft "
    "lebensmittelgeschaft menschlichkeit mitarbeiter nachrichtendienst rechtsanwaltskanzlei schwierigkeiten selbstverstandlich sicherheitsvorkehrungen unabhangigkeit "
    "unterschiedlich veranstaltung verantwortung verschiedene volkswirtschaft wahrscheinlich weihnachtsgeschichte wissenschaftler zusammenarbeit zwischenzeitlich "
    "accompagnement administratif apprentissage arrondissement bibliotheque changements communautaire connaissances constamment developpement difficilement "
    "enseignement essentiellement etablissement fonctionnement gouvernement heureusement immediatement investissements malheureusement naturellement particulierement "
    "quelquefois renseignements rapidement representants simultanement temperatures traditionnelle universitaires "
    "acontecimiento administraciones agradecimiento almacenamiento aproximadamente ayuntamiento caracteristicas comportamiento comunicaciones conocimientos "
    "constantemente correspondiente desarrollador descubrimiento desgraciadamente establecimiento extraordinario funcionamiento independientemente inmediatamente "
    "internacional investigaciones medioambiental posteriormente procedimientos responsabilidades significativamente trabajadores universidades"
).split()


def samples(spark: SparkSession, n: int = 1000) -> DataFrame:
    """(token, random) labelled samples: keys of several make, and identifiers joined from PARTS in several styles."""
    seeds = spark.range(n)
    noise = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    plain = F.regexp_replace(F.base64(noise), r"\s", "")
    keys = seeds.select(F.explode(F.array(plain, F.substring(plain, 3, 24), F.regexp_replace(plain, "[+/=]", ""), F.upper(F.regexp_replace(plain, "[+/=]", "")), F.sha2(F.col("id").cast("string"), 256), F.md5(F.col("id").cast("string")))).alias("token"))
    bare = F.regexp_replace(F.base64(F.concat(noise, F.unhex(F.md5(F.col("id").cast("string"))))), "[^A-Za-z]", "")
    size = (F.pmod(F.col("id"), F.lit(8)) + LEAST_TOKEN).cast("int")
    short = [F.regexp_replace(plain, "[+/=]", ""), bare, F.lower(bare), F.upper(bare)]
    keys = keys.unionByName(seeds.select(F.explode(F.array(bare, F.substring(bare, 3, 24), *[k.substr(F.lit(5), size) for k in short])).alias("token")))
    any_of = lambda words, k: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(words))) + 1).cast("int"))
    word, prose = lambda k: any_of(PARTS, k), lambda k: any_of(WORDS, k)
    number = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(3000)).cast("string")
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), F.pmod(F.col("id"), F.lit(9000)).cast("int")), "yyyy-MM-dd")
    styles = [
        F.concat_ws("_", word(1), word(2), word(3), number),
        F.concat_ws("-", word(1), word(2), number, word(3)),
        F.concat(word(1), F.initcap(word(2)), F.initcap(word(3)), number),
        F.concat(F.initcap(word(1)), F.initcap(word(2)), number, F.initcap(word(3))),
        F.concat_ws("/", word(1), word(2), number, word(3)),
        F.upper(F.concat_ws("_", word(1), number, word(2), word(3))),
        F.concat_ws("-", day, word(1), word(2)),
        F.concat(word(1), word(2), word(3), number),
        F.concat_ws("-", day, day),
        F.concat_ws("_", word(4), word(5), word(6)),
        F.concat_ws("-", word(5), word(6), word(7)),
        F.concat_ws("/", word(6), word(7), word(8)),
        F.concat(word(4), F.initcap(word(6)), F.initcap(word(8))),
        F.upper(F.concat_ws("_", word(5), word(7), word(8))),
        F.concat(word(7), word(4)),
        prose(1),
        F.initcap(prose(2)),
        F.upper(prose(3)),
        F.concat_ws("-", prose(4), word(1)),
        F.repeat(any_of("-=_+/", 5), size),
    ]
    names = seeds.select(F.explode(F.array(*styles)).alias("token"))
    return keys.withColumn("random", F.lit(1)).unionByName(names.withColumn("random", F.lit(0)))


def codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def ratios(labelled: DataFrame) -> list[float]:
    """Log ratio of each transition (first * N + second) under the two models, one added to each count."""
    pairs = labelled.withColumn("c", codes(F.col("token"))).select("random", F.explode(F.filter(F.zip_with("c", F.slice("c", F.lit(2), F.size("c")), lambda a, b: a * N + b), lambda x: x.isNotNull())).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 2 * N * N rows

    def log_p(label: int, a: int, b: int, total: int) -> float:
        return math.log((counts.get((label, a * N + b), 0) + 1) / (total + N))

    totals = {(label, a): sum(counts.get((label, a * N + b), 0) for b in range(N)) for label in (0, 1) for a in range(N)}
    return [log_p(1, a, b, totals[1, a]) - log_p(0, a, b, totals[0, a]) for a in range(N) for b in range(N)]


def mean_ratio(token: Column, table: list[float]) -> Column:
    """Mean log ratio of a token's transitions; 0 for tokens of one character."""
    values, rest = F.lit(table), F.greatest(F.length(token) - 1, F.lit(0))
    steps = F.zip_with(F.slice(codes(token), F.lit(1), rest), F.slice(codes(token), F.lit(2), rest), lambda a, b: F.element_at(values, a * N + b + 1))
    return F.aggregate(steps, F.lit(0.0), lambda total, x: total + x) / F.greatest(F.length(token) - 1, F.lit(1))


def threshold(labelled: DataFrame, table: list[float]) -> float:
    """Above all but one in a hundred of the samples of ordinary identifiers, and at least 0."""
    score = labelled.filter("random = 0").select(mean_ratio(F.col("token"), table).alias("s"))
    return max(0.0, score.agg(F.percentile("s", F.lit(0.99))).first()[0] or 0.0)


def _found(text: Column, pattern: str) -> Column:
    """[(all, gap, value)] of a pattern's leftmost matches: how long the match is with the text before it, how long that text is, and the
    pattern's group; none where the text has no match."""
    lazy = rf"(?s)\G(.*?)(?:{pattern})"  # \G: after the last match the search ends at once and is not begun anew at every character
    found = lambda group: F.regexp_extract_all(text, F.lit(lazy), F.lit(group))
    if pattern != ASSIGN:  # the group is the whole match, so what is left of it is the text before
        sizes = F.zip_with(found(0), found(2), lambda a, v: F.struct(F.length(a).cast("long").alias("all"), (F.length(a) - F.length(v)).cast("long").alias("gap"), v.alias("value")))
    else:
        pieces = F.arrays_zip(found(0).alias("a"), found(1).alias("b"), found(2).alias("v"))
        sizes = F.transform(pieces, lambda p: F.struct(F.length(p["a"]).cast("long").alias("all"), F.length(p["b"]).cast("long").alias("gap"), p["v"].alias("value")))
    return F.when(text.rlike(pattern), sizes).otherwise(F.lit(None))


_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def _placed(sizes: str) -> Column:
    """Starts and ends, from the running sum of what came before.

    The matches are cut into about as many blocks as a block has matches. Each block is summed up by itself, from the sum of those before
    it, so a text with n matches costs n * sqrt(n) steps and not n * n (every step of an aggregate copies what it has).
    """
    kind, none = f"struct<at:bigint,out:{_SPANS}>", F.array().cast(_SPANS)
    block = F.greatest(F.ceil(F.sqrt(F.size(sizes))), F.lit(1)).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), block), lambda k: F.slice(sizes, k, block))
    totals = F.transform(blocks, lambda own: F.aggregate(own, F.lit(0).cast("long"), lambda total, s: total + s["all"]))
    starts = F.aggregate(totals, F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    step = lambda acc, s: F.struct((acc["at"] + s["all"]).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["all"]).alias("end"), s["value"].alias("value")))).alias("out")).cast(kind)
    spans = F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), lambda own, at: F.aggregate(own, F.struct(at.alias("at"), none.alias("out")).cast(kind), step)["out"])
    return F.coalesce(F.when(F.size(sizes) > 0, F.flatten(spans)), none)


_PARTS = "array<struct<start:bigint,end:bigint,value:string,part:boolean,sure:boolean>>"


def _by_stretch(spans: Column, width: Column) -> Column:
    """Spans by the stretch of `width` characters that they touch, from the text's start to the last span's end."""
    stretches = F.sequence(F.lit(0).cast("long"), F.floor(F.coalesce(F.array_max(F.transform(spans, lambda b: b["end"])), F.lit(0)) / width))
    return F.transform(stretches, lambda k: F.filter(spans, lambda b: (b["start"] < (k + 1) * width) & (b["end"] > k * width)))


def _uncovered(token: Column, base: Column, width: Column, sure: Column) -> Column:
    """The parts of a token that no span of the patterns (base: by stretch) covers; the whole token where none touches it."""
    kind = f"struct<at:bigint,out:{_PARTS}>"
    first, last = F.floor(token["start"] / width), F.floor((token["end"] - 1) / width)
    here = F.when(first < F.size(base), F.flatten(F.slice(base, (first + 1).cast("int"), (last - first + 1).cast("int")))).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
    touching = F.array_sort(F.filter(F.array_distinct(here), lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"])))
    ends = F.concat(touching, F.array(F.struct(token["end"].alias("start"), token["end"].alias("end"))))

    def step(acc: Column, b: Column) -> Column:
        value = token["value"].substr((acc["at"] - token["start"] + 1).cast("int"), (b["start"] - acc["at"]).cast("int"))
        gap = F.struct(acc["at"].alias("start"), b["start"].alias("end"), value.alias("value"), (b["start"] - acc["at"] < token["end"] - token["start"]).alias("part"), sure.alias("sure"))
        out = F.when(acc["at"] < b["start"], F.concat(acc["out"], F.array(gap))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), out.alias("out")).cast(kind)

    first = F.struct(token["start"].alias("at"), F.array().cast(_PARTS).alias("out")).cast(kind)
    return F.aggregate(ends, first, step)["out"]


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, assign, access, hex, random: the spans of each kind in every text, as arrays of (start, end) in code points, end exclusive.

    random holds the Markov models' finds without what spans of the patterns cover; a part of 12 characters or more counts by itself as well.
    Every run of at least LEAST_TOKEN key characters is scored, digits or not; shorter ones are shorter than any value that the patterns
    count. Null texts are empty and hold nothing. Rows that repeat are scanned as often; rows without a doc_id are scanned too; very long texts
    are scanned whole, in n * sqrt(n) steps of their n tokens and spans. An empty table gives an
    empty result; other columns are not read. labelled(token, random) replaces the built-in samples.
    """
    known = (samples(docs.sparkSession) if labelled is None else labelled).select("token", F.col("random").cast("int").alias("random")).filter(F.length("token") > 1)
    table = ratios(known)
    cut = threshold(known, table)
    out = docs.select("doc_id", text_of().alias("t"))
    out = out.select("doc_id", *[_found(F.col("t"), p).alias(k) for k, p, _ in KINDS], _found(F.col("t"), TOKEN).alias("random"))
    out = out.select("doc_id", *[_placed(k).alias(k) for k in ("assign", "access", "hex", "random")])
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    long_enough = lambda kind, least: F.filter(kind, lambda s: F.length(s["value"]) >= least)
    out = out.select("doc_id", "random", *[bare(long_enough(k, least)).alias(k) for k, _, least in KINDS])
    base = F.concat("assign", "access", "hex")
    #: As many stretches as the root of the number of spans, so that a token is held against few of them.
    reach = F.coalesce(F.array_max(F.transform(base, lambda b: b["end"])), F.lit(1))
    out = out.withColumn("_width", F.ceil(reach / F.greatest(F.ceil(F.sqrt(F.size(base))), F.lit(1)))).withColumn("_base", _by_stretch(base, F.col("_width")))
    out = out.withColumn("random", F.flatten(F.transform("random", lambda s: _uncovered(s, F.col("_base"), F.col("_width"), mean_ratio(s["value"], table) > cut))))
    likely = F.filter("random", lambda p: p["sure"] | (p["part"] & (F.length(p["value"]) >= LEAST_TOKEN) & (mean_ratio(p["value"], table) > cut)))
    return out.select("doc_id", "assign", "access", "hex", bare(likely).alias("random"))


def listed(kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then kind as listed, comma-joined."""

    def said(n: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("said")))

    spans = F.concat(*[said(n, kind) for n, kind in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: s["said"]), ",")


def report(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of scan(); texts without spans have an empty list."""
    base = [k for k, _, _ in KINDS]
    return scanned.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in base], F.sha2(listed(base), 256).alias("base_sha256"), listed([*base, "random"]).alias("spans"))
