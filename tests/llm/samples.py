"""Documents with every odd case, and small helpers, for the tests of the text operators."""

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, row long, mark string, score string, print string, at long")
GAP = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def prose(seed, count, vocabulary=4000):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(count))


def texts():
    base = prose(1, 120)
    return [
        None, "", " \n\t ", "one", "one two", "One two THREE", base, base, base.replace(" ", "  \n"),
        base.replace("w1", "W1"), "Äpfel ß İstanbul Ünï ② ٣ 漢字 😀 e\u0301", "a" * 3000,
        "x " * 500, prose(2, 30_000), "line one is here\nline two is here\nline one is here\n\n",
        "#$%& <a|b> *** 'tis don't WE'LL", "<|endoftext|> in <|startoftext|> text",
        "\u2028 odd\u00a0spaces\x1c here\x85", prose(3, 40) + "\n" + prose(4, 40),
    ]


def odd(spark, extra=()):
    """Every odd text, some rows twice, a NULL doc_id, NULLs elsewhere and clashing column names."""
    rows = [(i, t) for i, t in enumerate([*texts(), *extra])]
    rows += [(6, texts()[6]), (3, "other text of a doc_id met before"), (None, "no id"),
             (None, None), (-5, "one")]
    return spark.createDataFrame(
        [(i, t, None, "s" if (i or 0) % 2 else None, None, 1, 2, "m", "s", "p", 3)
         for i, t in rows], SCHEMA,
    )


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]
