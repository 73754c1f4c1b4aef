"""License scans: Dice coefficient over word bigrams between licence templates and normalised text.

Text is lower-cased, runs of other characters than letters and digits become one blank. Two units of text are as alike
as the sets A and B of their word bigrams: 2 |A n B| / (|A| + |B|). That can reach ``THRESHOLD`` only if the smaller set
has at least s = THRESHOLD / (2 - THRESHOLD) of the size of the larger, and only if B holds s |A| of the bigrams of the
template A. So templates whose size does not fit a unit's are left out, and so are those of which the unit holds no
*seed*: the longest bigrams, so many that the others are fewer than s |A|. A text without any seed is done with.

The units of a text are

* its lines and, if it has several, the whole of it: such a unit gets the template most like it (the first by name, of equals);
* windows, for notices that are wrapped over lines or stand inside a longer text: as many words as a template has, laid
  so that a seed stands at the same place in both, cut at the ends of the text. A window does not count if a window of
  another licence lies over its middle word and is more alike (or as much, and comes first by name).

Of a document's units that match one licence, the best counts; of equals the whole text, then the first line, then the
first window. ``line`` is the line's number from 0, -1 for the whole text, null for a window; ``word`` is the number of
a window's first word, null for others. Null and empty texts, and units of fewer than two words, match nothing.
Repeated rows of a doc_id give one result; rows with one doc_id and differing texts are one document, the units of
which are those of all its texts. Each differing text without a doc_id is a document of its own. An empty table gives
none. Other columns are ignored. Bigrams are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.functions.binding import let
from pairsmith.llm.licences import TEMPLATES
from pairsmith.llm.tables import id_and_text, table

THRESHOLD = 0.8
NORMAL = r"[^\p{L}\p{N}]+"
WINDOWS = -(1 << 32)  # windows come after lines, whatever their place


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    """The bigrams in order, repeated ones too."""
    words = template_words(text)
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def seeds(bigrams: list[str], threshold: float = THRESHOLD) -> set[str]:
    """Bigrams of which each text that reaches the threshold holds one: the longest."""
    known = sorted(set(bigrams), key=lambda g: (-len(g), g))
    shared = math.ceil(len(known) * threshold / (2 - threshold) - 1e-9)
    return set(known[:len(known) - shared + 1])


def _usable(templates: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    return [(name, grams) for name, grams in ((n, template_bigrams(t)) for n, t in sorted(set(templates))) if grams]


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), NORMAL, " ")), " ")


def _bigrams(words: Column) -> Column:
    """Hashes of the bigrams in order."""
    return let(words, lambda w: F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda second, i: F.xxhash64(F.get(w, i), second)))


def _hashes(spark: SparkSession, grams: list[list[str]]) -> list[list[int]]:
    texts = F.array(*[F.lit(" ".join([g.split(" ")[0] for g in gs] + [gs[-1].split(" ")[1]])) for gs in grams])
    row = spark.range(1).select(F.transform(texts, lambda t: _bigrams(F.split(t, " "))).alias("h")).first()
    return [list(h) for h in row["h"]]


def _longs(values) -> str:
    return "array(%s)" % ", ".join(f"{v}L" for v in values)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, line, word: the best unit of every document for each licence that it reaches."""
    texts = id_and_text(docs).where("text is not null")
    usable = _usable(templates)
    hashes = _hashes(docs.sparkSession, [g for _, g in usable])
    share = threshold / (2 - threshold)
    longest = max(len(h) for h in hashes) + 1
    # Where a window of a template begins, for a seed at place 0: template number and place in one number.
    places: dict[int, list[int]] = {}
    for k, ((_, grams), hashed) in enumerate(zip(usable, hashes)):
        chosen = seeds(grams, threshold)
        for at, (gram, h) in enumerate(zip(grams, hashed)):
            if gram in chosen:
                places.setdefault(h, []).append((k << 32) + longest - at)
    begins = F.expr("map(%s)" % ", ".join(f"{h}L, {_longs(v)}" for h, v in places.items()))
    known = F.expr("array(%s)" % ", ".join(
        f"named_struct('license', '{name}', 'place', {-k}, 'words', {len(h) + 1}, 'grams', {_longs(dict.fromkeys(h))})"
        for k, ((name, _), h) in enumerate(zip(usable, hashes))))

    def starts(grams: Column) -> Column:
        """Template and place of every window, as numbers."""
        found = F.filter(F.transform(grams, lambda g, i: F.when(g.isin(list(places)), i)), lambda i: i.isNotNull())
        return F.array_distinct(F.flatten(F.transform(found, lambda i: F.transform(begins[F.get(grams, i)], lambda c: c + i))))

    def fits(grams: Column, t: Column) -> Column:
        return (F.size(t["grams"]) >= F.size(grams) * share) & (F.size(t["grams"]) <= F.size(grams) / share)

    def dice(grams: Column, t: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + F.size(t["grams"]))

    def find(license_: Column, like: Column, at: Column, begin: Column, end: Column) -> Column:
        return F.struct(license_.alias("license"), like.alias("dice"), at.cast("long").alias("at"), begin.cast("int").alias("begin"), end.cast("int").alias("end"))

    def window(grams: Column, start: Column) -> Column:
        def rate(t: Column, place: Column) -> Column:
            begin, end = F.greatest(place, F.lit(0)), F.least(place + t["words"], F.size(grams) + 1)
            return let(F.array_distinct(F.slice(grams, begin + 1, end - begin - 1)), lambda g: F.when(
                fits(g, t), find(t["license"], dice(g, t), F.lit(WINDOWS) - begin, begin, end)))
        place = (start.bitwiseAND(F.lit((1 << 32) - 1)) - longest).cast("int")
        return let(F.get(known, F.shiftright(start, 32).cast("int")), lambda t: rate(t, place))

    def unit(text: Column, line: Column) -> Column:
        """The best of the templates that fit the set's size and have a seed in it."""
        def rate(grams: Column, numbers: Column) -> Column:
            chosen = F.array_distinct(F.transform(numbers, lambda c: F.shiftright(c, 32).cast("int")))
            fitting = F.filter(F.transform(chosen, lambda k: F.get(known, k)), lambda t: fits(grams, t))
            best = F.array_max(F.transform(fitting, lambda t: F.struct(dice(grams, t).alias("dice"), t["place"].alias("place"), t["license"].alias("license"))))
            return let(best, lambda b: find(b["license"], b["dice"], -line, F.lit(None), F.lit(None)))
        return let(F.array_distinct(_bigrams(_words(text))), lambda g: let(starts(g), lambda c: F.when(F.size(c) > 0, rate(g, c))))

    def finds(grams: Column, numbers: Column) -> Column:
        lines = F.split("text", "\n")
        units = F.transform(lines, lambda line, i: unit(line, i))
        whole = F.when(F.size(lines) > 1, F.array(unit(F.col("text"), F.lit(-1)))).otherwise(F.slice(units, 1, 0))
        every = F.concat(F.transform(numbers, lambda c: window(grams, c)), units, whole)
        return F.filter(every, lambda f: f["dice"] >= threshold)

    found = let(_bigrams(_words(F.col("text"))), lambda g: let(starts(g), lambda c: F.when(F.size(c) > 0, finds(g, c))))
    rows = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(found).alias("f")).select("doc_id", "text_hash", "f.*")
    best = _undisputed(rows, longest).groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("only"), "license") \
        .agg(F.max(F.struct("dice", "at")).alias("best"))
    at = F.col("best.at")
    return best.select("doc_id", "license", "best.dice", F.when(at > WINDOWS, -at).cast("int").alias("line"),
                       F.when(at <= WINDOWS, F.lit(WINDOWS) - at).cast("int").alias("word"))


def _undisputed(finds: DataFrame, longest: int) -> DataFrame:
    """Finds without the windows whose middle word a window of another licence covers better.

    Windows meet in cells of as many words as the longest template has, so what meets depends on the templates, not on
    the length of a text. Cells of windows are numbered down from 0; a line has a cell of its own above."""
    cell = F.when(F.col("begin").isNull(), F.array(F.col("at") - WINDOWS)) \
        .otherwise(F.sequence(-F.floor(F.col("begin") / longest), -F.floor((F.col("end") - 1) / longest)))
    cells = finds.withColumn("cell", F.explode(cell)).groupBy("doc_id", "text_hash", "cell") \
        .agg(F.collect_set(F.struct("license", "dice", "at", "begin", "end")).alias("near"))

    def middle(f: Column) -> Column:
        return F.floor((f["begin"] + f["end"]) / 2)

    def beats(b: Column, a: Column) -> Column:
        better = (b["dice"] > a["dice"]) | ((b["dice"] == a["dice"]) & (b["license"] < a["license"]))
        return (b["license"] != a["license"]) & better & (b["begin"] <= middle(a)) & (middle(a) < b["end"])

    def stays(a: Column) -> Column:
        return a["begin"].isNull() | ((-F.floor(middle(a) / longest) == F.col("cell")) & ~F.exists("near", lambda b: beats(b, a)))

    return cells.select("doc_id", "text_hash", F.explode(F.filter("near", stays)).alias("f")).select("doc_id", "text_hash", "f.license", "f.dice", "f.at")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in the documents."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    usable = _usable(TEMPLATES)
    values = ", ".join("(%d, '%s', %d, %s)" % (k, n, len(g) + 1, sorted(set(g))) for k, (n, g) in enumerate(usable))
    places = ", ".join(f"({k}, '{gram}', {at})" for k, (_, g) in enumerate(usable) for chosen in [seeds(g)] for at, gram in enumerate(g) if gram in chosen)
    share = THRESHOLD / (2 - THRESHOLD)
    return rf"""
WITH t(k, license, n, grams) AS (VALUES {values}),
s(k, gram, o) AS (VALUES {places}),
u AS (SELECT doc_id, i - 1 AS line, lines[i] AS unit FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS x(i)
      UNION ALL SELECT doc_id, -1, text FROM documents WHERE contains(text, chr(10))),
w AS (SELECT doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS words FROM u),
g AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams FROM w WHERE len(words) > 1),
d AS (SELECT doc_id, line, license, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice FROM g, t
      WHERE len(t.grams) >= len(g.grams) * {share!r} AND len(t.grams) <= len(g.grams) / {share!r}),
units AS (SELECT * FROM d WHERE dice >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1),
a AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS words FROM documents),
b AS (SELECT doc_id, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS grams FROM a WHERE len(words) > 1),
c AS (SELECT DISTINCT doc_id, k, p - 1 - o AS start FROM (SELECT doc_id, p, grams[p] AS gram FROM b, unnest(range(1, len(grams) + 1)) AS x(p)) JOIN s USING (gram)),
e AS (SELECT doc_id, license, greatest(start, 0) AS f, least(start + n, len(b.grams) + 1) AS l, t.grams AS tg,
             list_distinct(list_slice(b.grams, greatest(start, 0) + 1, least(start + n, len(b.grams) + 1) - 1)) AS wg FROM c JOIN t USING (k) JOIN b USING (doc_id)),
r AS (SELECT doc_id, license, f, l, 2.0::DOUBLE * len(list_intersect(wg, tg)) / (len(wg) + len(tg)) AS dice FROM e
      WHERE len(tg) >= len(wg) * {share!r} AND len(tg) <= len(wg) / {share!r} AND dice >= {THRESHOLD}),
windows AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM r AS q WHERE q.doc_id = r.doc_id AND q.license <> r.license AND q.f <= (r.f + r.l) // 2 AND (r.f + r.l) // 2 < q.l
            AND (q.dice > r.dice OR (q.dice = r.dice AND q.license < r.license)))),
every AS (SELECT doc_id, license, dice, line::INTEGER AS line, NULL::INTEGER AS word FROM units UNION ALL SELECT doc_id, license, dice, NULL, f::INTEGER FROM windows)
SELECT doc_id, license, dice, line, word FROM every
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, line NULLS LAST, word) = 1
"""


SQL = _sql()
