"""Licences of files: TF-IDF cosine to templates, then inheritance from directories.

Passages (every line and paragraph of a file, its leading comment, and the whole of a
licence file) are compared with licence statements, titles, headers and short licences
as sparse vectors; besides, the version and the variant a template names must be those
of the passage. Only passages that hold a telling word of a template are taken apart.
Document frequencies are counted over all lines of all files, as shares of the lines, so
that a larger table with the same proportions gives the same scores. A file without a licence of its
own takes that of the licence file in the nearest directory above it, found by
joining directories with their ancestors. Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..sources.staged import files_for, shared_folder, stage
from .license_texts import TEMPLATES
from .quality_rules import STOP_WORDS
from .words import unused

LICENSE_FILE = r"(?i)^(license|licence|copying|notice)([.\-_].*)?$"
THRESHOLD = 0.7
# Added to the share of lines that hold a word, so that a word in none has a weight.
SMOOTHING = 1e-3
SPLIT = r"[^\p{L}\p{N}]+"
# Lines of a comment, and the comment that a file starts with.
_COMMENT = r"(?:[ \t]*+(?:#|//|/?\*|--|;|%)[^\n]*+(?:\n|\z))++"
_LEADING = (
    r"\A(?:#![^\n]*\n)?\s*+(/\*[\s\S]*?\*/|<!--[\s\S]*?-->|\"\"\"[\s\S]*?\"\"\"|" + _COMMENT + ")"
)
# Lines without a letter or digit part paragraphs.
_GAP = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
# What must agree, as (pattern, mark), the first that is found; the patterns are for
# lower-case text and mean the same in Java and Python.
_VERSION = (
    r"(?:version|licen[cs]es?|\bv|\bver|gpl|mpl|apache|mit|cc0|zero|commons|\bby|\bsa|\bnc|\bnd|"
    r"attribution|sharealike|noncommercial|noderivatives|noderivs)[^a-z0-9]{0,6}"
    r"(?:version|ver|v)?[^a-z0-9]{0,6}([0-9]+(?:\.[0-9]+)*)"
)
_CLAUSES = r"\b([0-9])[ -]clause"
_GNU = [
    (r"affero|\bagpl", "A"), (r"\blesser\b|\blgpl|library\s+general\s+public", "L"),
    (r"general[^a-z]+public|\bgpl", "G"),
]
_CC = [
    (r"\bby[ /-]+nc[ /-]+sa\b|noncommercial[ -]+sharealike", "NC-SA"),
    (r"\bby[ /-]+nc[ /-]+nd\b|noncommercial[ -]+noderiv", "NC-ND"),
    (r"\bby[ /-]+nc\b|attribution[ -]+non-?commercial", "NC"),
    (r"\bby[ /-]+sa\b|attribution[ -]+share-?alike", "SA"),
    (r"\bby[ /-]+nd\b|attribution[ -]+no-?deriv", "ND"),
    (r"\bcc[ /-]+by\b|commons\s+attribution", "BY"),
]
_BSD = [
    (r"advertising[^a-z]+materials", "4"), (r"endorse[^a-z]+or[^a-z]+promote", "3"),
    (r"redistributions[^a-z]+of[^a-z]+source", "2"),
]
_MARKS = {"gnu": _GNU, "cc": _CC, "bsd": _BSD}
# Of long templates only these words call for a comparison.
_LONG = 12
_LEGAL = {
    "license", "licensed", "licenses", "copyright", "permission", "redistribution",
    "redistribute", "unencumbered", "gnu", "apache", "mozilla", "mpl",
}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def _idf(share: float) -> float:
    """Weight of a word in that share of the lines."""
    return math.log((1 + SMOOTHING) / (share + SMOOTHING)) + 1


def template_words(templates: list[tuple[str, str]]) -> list[tuple[str, str, str, int]]:
    """(template number, licence, word, how often) of every template."""
    import re

    out = []
    for i, (name, text) in enumerate(templates):
        words = re.findall(r"[^\W_]+", text.lower())
        out += [(f"{i:03d}", name, w, words.count(w)) for w in sorted(set(words))]
    return out


def anchors(templates: list[tuple[str, str]]) -> list[str]:
    """Words that a passage needs one of: those of templates that are no stop words
    and have a letter and two characters at least. Of a long template those that name
    a licence or grant are enough, if it has any."""
    common = {
        *STOP_WORDS, "under", "work", "terms", "by", "sa", "nc", "nd", "subject", "no", "code",
        "january", "february", "june", "november", "www", "org", "http", "or", "later", "only",
    }
    out: set[str] = set()
    for template in templates:
        words = {w for _, _, w, _ in template_words([template])}
        words = {w for w in words if w not in common and len(w) > 1 and not w.isdigit()}
        out |= words & _LEGAL if len(words) > _LONG and words & _LEGAL else words
    return sorted(out)


def demands(templates: list[tuple[str, str]]) -> list[tuple[str, str, str, str, str]]:
    """(template number, version, GNU, CC and BSD variant) that a passage must have;
    an empty text asks for nothing."""
    import re

    out = []
    for i, (_, text) in enumerate(templates):
        low = text.lower()
        found = re.findall(_VERSION, low) + re.findall(_CLAUSES, low)
        marks = [
            next((m for pattern, m in kind if re.search(pattern, low)), "")
            for kind in _MARKS.values()
        ]
        out.append((f"{i:03d}", re.sub(r"(\.0)+$", "", found[0]) if found else "", *marks))
    return out


def _marked(low: Column) -> dict[str, Column]:
    """Versions and variants of a passage, given in lower case."""
    found = F.concat(*[F.regexp_extract_all(low, F.lit(p), F.lit(1)) for p in (_VERSION, _CLAUSES)])
    out = {"versions": F.transform(found, lambda v: F.regexp_replace(v, r"(\.0)+$", ""))}
    for name, kind in _MARKS.items():
        first = [F.when(low.rlike(p), F.lit(m)) for p, m in kind]
        out[name] = F.coalesce(*first, F.lit(""))
    return out


def values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small fixed table."""
    def literal(v: object) -> str:
        if isinstance(v, float):
            return f"{v!r}D"
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def _numbered(bodies: Column, number: Callable[[Column], Column]) -> Column:
    return F.transform(
        bodies, lambda x, i: F.struct(number(i).cast("int").alias("passage"), x.alias("body"))
    )


def passages(files: DataFrame) -> DataFrame:
    """(path, passage, body): lines numbered from 0, a licence file's whole as -1, the
    leading comment as -2 and paragraphs of several lines from -3 downwards."""
    text = F.col("text")
    none = F.array().cast("array<string>")
    is_license = F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENSE_FILE)
    leading = F.regexp_extract("text", _LEADING, 1)
    apart = F.regexp_replace(text, "(?m)(^" + _COMMENT + ")", "\n$1\n")
    blocks = F.filter(F.split(apart, _GAP), lambda x: F.trim(x, F.lit("\n")).contains("\n"))
    bodies = F.concat(
        _numbered(F.split("text", "\n"), lambda i: i),
        _numbered(F.when(is_license, F.array(text)).otherwise(none), lambda i: F.lit(-1)),
        _numbered(
            F.when(leading.contains("\n"), F.array(leading)).otherwise(none), lambda i: F.lit(-2)
        ),
        _numbered(blocks, lambda i: -i - 3),
    )
    return files.filter("text IS NOT NULL").select("path", F.explode(bodies).alias("p")).select(
        "path", "p.passage", "p.body"
    )


def own_licenses(
    files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(path, license, score) of files with a passage close to a template.

    The best passage counts; of equal scores the first template's licence. A template
    that names a version or a variant (Lesser, Affero, NC, SA, ND, the clauses of BSD)
    meets only passages that name it too.
    """
    spark = files.sparkSession
    folder = shared_folder(spark, "words")
    rows = template_words(templates)
    every = passages(files)
    telling = r"(?i)(?<![\p{L}\p{N}])(" + "|".join(anchors(templates)) + r")(?![\p{L}\p{N}])"
    # Few passages are near a template; the texts are split and searched once for all that follows.
    near = stage(every.filter(F.col("body").rlike(telling)), f"{folder}/near")
    # What follows from them is written in files by its size, not one per shuffle partition;
    # a word and its gap take two characters at least.
    found, letters = near.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("body")), F.lit(0))).first()
    few = files_for(letters // 2)
    words = near.select("path", "passage", F.explode(_words(F.col("body"))).alias("word"))
    often = stage(
        words.groupBy("path", "passage", "word").agg(F.count(F.lit(1)).alias("often")).coalesce(few),
        f"{folder}/often",
    )
    # In how many lines a word is, kept for the words of passages to be compared and
    # of templates.
    lines = F.split("text", "\n")
    held = F.flatten(F.transform(lines, lambda x: F.array_distinct(_words(x))))
    texts = files.filter("text IS NOT NULL")
    counted = texts.select(F.explode(held).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("df")
    )
    total = texts.agg(F.sum(F.size(lines).cast("long"))).first()[0] or 0
    vocabulary = sorted({r[2] for r in rows})
    asked_for = often.select("word").unionByName(
        values(spark, [(w,) for w in vocabulary], "word")
    ).distinct()
    # The join reads the words of all files, so its few rows are moved and its tasks stay many.
    known = stage(
        counted.join(asked_for, "word", "left_semi").repartition(few), f"{folder}/known"
    )
    in_templates = known.join(
        F.broadcast(values(spark, [(w,) for w in vocabulary], "word")), "word", "left_semi"
    )
    counts = {r["word"]: r["df"] for r in in_templates.collect()}  # words of templates only
    weight = {w: _idf(counts.get(w, 0) / max(total, 1)) for w in vocabulary}
    square: dict[str, float] = {}
    for template, _, word, n in rows:
        square[template] = square.get(template, 0.0) + (n * weight[word]) ** 2
    table = values(
        spark, [(t, name, w, n * weight[w] / square[t] ** 0.5) for t, name, w, n in rows],
        "template, license, t_word, t",
    )
    share = F.coalesce(F.col("df"), F.lit(0)) / F.lit(float(max(total, 1)))
    # The vocabulary grows with the texts, so it is never broadcast; frequent words are split.
    weighed = salted_join(often, known, "word").withColumn(
        "w", F.col("often") * (F.log((1 + SMOOTHING) / (share + SMOOTHING)) + 1)
    )
    marks = near.select("path", "passage", F.lower("body").alias("low")).select(
        "path", "passage", *[c.alias(n) for n, c in _marked(F.col("low")).items()]
    ).distinct()  # rows with equal paths
    asked = F.broadcast(values(
        spark, demands(templates), "a_template, a_version, a_gnu, a_cc, a_bsd"
    ))
    size = weighed.groupBy("path", "passage").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size")
    )
    shared = weighed.join(F.broadcast(table), F.col("word") == F.col("t_word")).groupBy(
        "path", "passage", "template", "license"
    ).agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    scored = shared.join(size, ["path", "passage"]).withColumn(
        "score", F.round(F.col("dot") / F.col("size"), 6)
    ).filter(F.col("score") >= threshold)
    scored = scored.join(marks, ["path", "passage"]).join(
        asked, F.col("template") == F.col("a_template")
    ).filter(
        ((F.col("a_version") == "") | F.array_contains("versions", F.col("a_version")))
        & reduce(lambda a, b: a & b, [
            (F.col(f"a_{m}") == "") | (F.col(f"a_{m}") == F.col(m)) for m in _MARKS
        ])
    )
    best = F.max_by("license", F.struct("score", (-F.col("template").cast("int")).alias("t")))
    licensed = scored.groupBy("path").agg(best.alias("license"), F.max("score").alias("score"))
    return licensed.coalesce(files_for(found))


def directory(path: Column) -> Column:
    """The directory of a path, the root being an empty text."""
    return F.regexp_replace(F.regexp_extract(path, r"^(.*/)?", 0), "/$", "")


def license_scan(
    files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Add ``license``, ``score``, ``license_from`` and ``inherited`` to files.

    ``files`` has ``path`` (parts split by ``/``) and ``text``. ``license_from`` is the
    path whose text gave the licence, the file's own or a licence file's of the nearest
    directory above; without one all but ``inherited`` (false) are NULL. Of several
    licence files in a directory the best score counts, then the first path.

    * NULL texts have no licence of their own but may inherit; empty ones too.
    * A NULL path has neither. Rows with equal paths are taken as one file: each gets
      the best licence found under that path.
    * Texts are read whole. Other columns stay; columns named like a result are
      replaced. An empty table gives an empty result.
    """
    spark = files.sparkSession
    folder = shared_folder(spark, "licenses")
    results = {"license", "score", "license_from", "inherited"}
    files = files.select(*[F.col(f"`{c}`") for c in files.columns if c.lower() not in results])
    plain = files.select("path", "text").filter("path IS NOT NULL")
    own = stage(own_licenses(plain, templates, threshold), f"{folder}/own")
    places = (
        own.filter(F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENSE_FILE))
        .withColumn("home", directory(F.col("path")))
        .groupBy("home")
        .agg(
            F.min_by(
                F.struct("score", "path", "license"), F.struct(-F.col("score"), F.col("path"))
            ).alias("source")
        )
    )
    # Files may have columns of any name.
    stems = ("dir", "own_path", "own_license", "own_score", "source")
    dir_, own_path, own_license, own_score, source = (unused(files.columns, f"__{n}") for n in stems)
    folders = plain.select(directory(F.col("path")).alias(dir_)).distinct()
    parts = F.filter(F.split(dir_, "/"), lambda x: x != "")
    above = folders.select(
        dir_,
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size(parts)),
                lambda i: F.struct(
                    i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("at")
                ),
            )
        ).alias("a"),
    ).select(dir_, "a.depth", "a.at")
    nearest = (
        above.join(places, F.col("at") == F.col("home"))
        .groupBy(dir_).agg(F.max_by("source", "depth").alias(source))
    )
    named = own.select(
        F.col("path").alias(own_path), F.col("license").alias(own_license),
        F.col("score").alias(own_score),
    )
    rows = files.withColumn(dir_, directory(F.col("path")))
    joined = rows.join(named, F.col("path") == F.col(own_path), "left")
    # A flat directory may hold a third of all files.
    joined = salted_join(joined, nearest, dir_, spread=["path"])
    mine = F.col(own_path).isNotNull()
    return joined.select(
        *[F.col(f"`{c}`") for c in files.columns],
        F.coalesce(own_license, f"{source}.license").alias("license"),
        F.coalesce(own_score, f"{source}.score").alias("score"),
        F.when(mine, F.col(own_path)).otherwise(F.col(f"{source}.path")).alias("license_from"),
        (~mine & F.col(source).isNotNull()).alias("inherited"),
    )
