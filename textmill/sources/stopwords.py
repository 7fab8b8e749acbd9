"""Stop-word lists.

The list is a parameter: pass ``path`` (one word per line, the format the
reference reads) to use your own.  Without it a short list of English function words
kept in this module is used, so driver-side code (the SQL oracle, the session)
and tasks see the same words wherever they run.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import EXTRA_STOP_WORDS

#: Common function words of each profile language, without repeats inside a list.
WORDS = {
    "en": """a about above after again all am an and any are as at be because been before being below between both
        but by can could did do does doing down during each few for from further had has have having he her here hers
        him his how i if in into is it its just me more most my no nor not now of off on once only or other our out
        over own same she should so some such than that the their them then there these they this those through to
        too under until up very was we were what when where which while who whom why with would you your""",
    "fr": """au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui ma mais me moi mon
        ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te toi ton tu un une vos votre vous
        sont plus cette comme""",
    "de": """aber als am an auch auf aus bei bin bis bist da damit das dass dein dem den der des die dies dir doch
        du durch ein eine einem einen einer es für hat hatte ich ihm ihn ihr im in ist ja kein man mein mich mir
        mit nach nicht noch nun nur ob oder ohne sich sie sind so um und uns vom von vor war was wie wir zu zum zur""",
    "es": """al algo como con contra cual cuando de del desde donde el ella ellos en entre era es esa ese esta este
        fue ha hasta hay la las le les lo los mi mucho muy nada ni no nos o os otra para pero poco por porque que
        quien se ser si sin sobre son su sus también te tiene todo tu un una uno y ya yo""",
}


@functools.lru_cache(maxsize=None)
def stop_words(language: str = "en") -> tuple[str, ...]:
    """The package's own list for ``language``."""
    return tuple(WORDS[language].split())


def read_stop_words(path: str) -> tuple[str, ...]:
    """Read a one-word-per-line file on the driver (lists are small config)."""
    with open(path, encoding="utf-8") as fh:
        return tuple(line.rstrip("\n") for line in fh if line.rstrip("\n"))


def topic_stop_words(path: str | None = None, extra=tuple(EXTRA_STOP_WORDS)) -> list[str]:
    """Stop list of the topic job: the list file (or the English list)
    plus the two extra words the job appends."""
    base = read_stop_words(path) if path else stop_words("en")
    seen, out = set(), []
    for w in list(base) + list(extra):
        if w not in seen:
            seen.add(w)
            out.append(w)
    return out


def stop_words_frame(spark: SparkSession, words) -> DataFrame:
    """The list as a one-column DataFrame ``word`` (for anti-joins)."""
    return spark.createDataFrame([(w,) for w in words], "word string")


def stop_words_from_text(spark: SparkSession, path: str) -> DataFrame:
    """Distributed read of a large list: ``spark.read.text``, trimmed, unique."""
    return (spark.read.text(path)
            .select(F.col("value").alias("word"))
            .filter(F.col("word") != "")
            .distinct())


def language_profiles() -> list[tuple[str, str]]:
    """(lang, word) rows of the profile languages."""
    return [(code, w) for code in sorted(WORDS) for w in sorted(stop_words(code))]
