"""Line-first cleaning with quality rules for lines and documents; JVM only.

Each line is judged alone: by its punctuation (too many signs or doubled
exclamation marks for its words), as navigation (cells between bars, or few
words without an end), as boilerplate (a fixed phrase, English, German, French or
Spanish whatever the document's language, in a short line) and by stuttering (one word after the other repeated). Failing lines are removed, and a
document that loses too many of its words is rejected.

Cases: a null text has no words, fails the base rules and stays null; blank lines
count for nothing; a text may be one long line. Every input row gives one output
row; columns named like a result are replaced, others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import SPACES, require, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MOST_REPEATED = 30  # percent of the words
MOST_LOST = 40  # percent of the words
SIGNS_PER_WORD = 0.5
FEW_WORDS = 4
SHORT_LINE = 40
# Phrases of lines that are not part of a text, by language.
BOILERPLATE = {
    "en": [
        "all rights reserved",
        "licensed under the",
        "terms of use",
        "terms of service",
        "privacy policy",
        "cookie policy",
        "uses cookies",
        "subscribe to our newsletter",
        "sign up for our",
        "click here to",
        "skip to content",
        "back to top",
        "enable javascript",
        "lorem ipsum",
    ],
    "de": [
        "alle rechte vorbehalten",
        "lizenziert unter",
        "nutzungsbedingungen",
        "datenschutzerklärung",
        "verwendet cookies",
        "newsletter abonnieren",
        "klicken sie hier",
        "zum inhalt springen",
        "zum seitenanfang",
        "javascript aktivieren",
    ],
    "fr": [
        "tous droits réservés",
        "distribué sous licence",
        "conditions d['’]utilisation",
        "politique de confidentialité",
        "utilise des cookies",
        "abonnez-vous à notre",
        "cliquez ici pour",
        "aller au contenu",
        "haut de page",
        "activer javascript",
    ],
    "es": [
        "todos los derechos reservados",
        "publicado bajo la licencia",
        "condiciones de uso",
        "términos de uso",
        "política de privacidad",
        "utiliza cookies",
        "suscríbete a nuestro",
        "haz clic aquí",
        "saltar al contenido",
        "volver arriba",
    ],
}


def _without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in windows of eight that occur twice, first ones included.

    Hash and place of each window are packed into one long, so one sort of plain
    longs brings equal windows together.
    """
    bits = F.length(F.bin(n))
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - WINDOW + 1)).otherwise(
        F.array().cast("array<int>")
    )
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return hashes, bits


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and ``base_failed``; ``rule_*`` columns are working space."""
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({"rule_words": word_array(body)})
    out = out.withColumn("rule_n", F.size("rule_words"))
    hashes, bits = _repeat_words(F.col("rule_words"), F.col("rule_n"))
    out = out.withColumns({"rule_hashes": hashes, "rule_bits": bits})
    packed = F.expr(
        "transform(rule_hashes, (h, i) -> shiftleft(shiftright(h, rule_bits), rule_bits) | i)"
    )
    out = out.withColumn("rule_sorted", F.sort_array(packed))
    twice = F.expr(
        """flatten(zip_with(slice(rule_sorted, 1, greatest(size(rule_sorted) - 1, 0)),
             slice(rule_sorted, 2, greatest(size(rule_sorted) - 1, 0)),
             (a, b) -> if(shiftright(a, rule_bits) = shiftright(b, rule_bits),
               array(a & (shiftleft(1L, rule_bits) - 1), b & (shiftleft(1L, rule_bits) - 1)),
               cast(array() as array<bigint>))))"""
    )
    out = out.withColumn("rule_places", F.sort_array(F.array_distinct(twice)))
    covered = F.expr(
        f"""aggregate(zip_with(rule_places, slice(rule_places, 2, greatest(size(rule_places), 1)),
             (a, b) -> least({WINDOW}L, coalesce(b - a, {WINDOW}L))), 0L, (t, x) -> t + x)"""
    )
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(_without(x, SPACES)) > 0)
    out = out.withColumn("rule_lines", lines)
    return out.withColumns(
        {
            "n_words": F.col("rule_n").cast("long"),
            "word_chars": F.length(_without(body, SPACES)).cast("long"),
            "n_symbols": (F.length(body) - F.length(_without(body, SYMBOLS))).cast("long"),
            "n_dup_lines": (
                F.size("rule_lines") - F.size(F.array_distinct("rule_lines"))
            ).cast("long"),
            "n_repeat_words": covered,
        }
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )


def _measured(line: Column) -> Column:
    """What the rules of a line look at; in a struct, so that each is computed once."""
    length = F.length(line)
    return F.struct(
        line.alias("line"),
        word_array(line).alias("words"),
        (length - F.length(_without(line, SYMBOLS))).alias("signs"),
        (length - F.length(F.replace(line, F.lit("|"), F.lit("")))).alias("bars"),
        (length - F.length(F.replace(line, F.lit("!!"), F.lit("")))).alias("shouts"),
    )


def _judged(x: Column) -> Column:
    """A measured line with its number of words and the rule that it fails, if any."""
    n = F.size(x.words)
    ends = F.rtrim(F.right(x.line, F.lit(4))).rlike(r"[.!?:;…。！？\"'»”)\]]$")
    # Phrases are tried where a word starts only.
    phrase = x.line.rlike(r"(?iu)\b(?:" + "|".join(p for own in BOILERPLATE.values() for p in own) + ")")
    stutter = (n >= 10) & (F.size(F.array_distinct(x.words)) * 4 < n)
    rule = (
        F.when((x.bars >= 2) & (x.bars * 3 >= n), "navigation")
        .when((n < FEW_WORDS) & ~ends, "navigation")
        .when((x.signs > SIGNS_PER_WORD * n) | (x.shouts > 2 * SIGNS_PER_WORD * n), "punctuation")
        .when((n <= SHORT_LINE) & phrase, "boilerplate")
        .when(stutter, "stutter")
    )
    return F.struct(x.line.alias("line"), n.alias("n"), rule.alias("rule"))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with base counts, ``clean_text``, removed lines and words, ``kept``."""
    require(docs, text)
    added = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "clean_text", "n_lines_removed", "n_words_removed", "kept",
    ]
    docs = docs.drop(*[c for c in added if c != text])
    out = base_columns(docs, text)
    out = out.withColumn("rule_measured", F.transform("rule_lines", _measured))
    out = out.withColumn("rule_judged", F.transform("rule_measured", _judged))
    out = out.withColumn("rule_bad", F.filter("rule_judged", lambda x: x.rule.isNotNull()))
    good = F.filter("rule_judged", lambda x: x.rule.isNull())
    lost = F.aggregate("rule_bad", F.lit(0).cast("long"), lambda t, x: t + x.n)
    out = out.withColumns(
        {
            "clean_text": F.when(
                F.col(text).isNotNull(), F.array_join(F.transform(good, lambda x: x.line), "\n")
            ),
            "n_lines_removed": F.size("rule_bad").cast("long"),
            "n_words_removed": lost,
        }
    )
    keep = ~F.col("base_failed") & (
        100 * F.col("n_words_removed") <= MOST_LOST * F.col("n_words")
    )
    return out.withColumn("kept", keep).select(*docs.columns, *added)
