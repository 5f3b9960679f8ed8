"""Fill-in-middle transformation by a counted-quantifier regular expression (operator 12).

A text is ``n`` units, each a word with the white space before it, or white space at the end;
``regexp_count`` gives n. A hash of the ``doc_id`` draws two cuts a <= b from 0 to n and the
form. The pattern of the row, ``(unit{a})(unit{b - a})(rest)`` with possessive quantifiers, then
captures prefix, middle and suffix in one match, and the replacement puts them in their new order
between the sentinels. Possessive groups are loops: no backtracking, and no stack that grows with
the text.

A text that holds a sentinel stays plain, so the sentinels of an output are its own, and
:func:`restored` finds the parts again. Every row is worked on by itself, with DataFrame
functions only: no shuffle, and one text in memory at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SEED = 42
#: Percent of the documents that are transformed, and of these, in suffix-prefix-middle order.
RATE, SPM = 50, 80

# The sentinels and the unit, plainly and without backtracking.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"

#: The output of each form, by captured group.
_ORDER = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def _parts(output: Column) -> Column:
    """What stands behind each sentinel of a transformed output, in the output's order."""
    return F.split(F.substr(output, F.lit(len(PREFIX) + 1)), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`transform` made ``output`` of, exactly."""
    parts = _parts(output)
    first, second, middle = (F.get(parts, F.lit(k)) for k in range(3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )


def _named(rows: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and ``columns``, which are made once, however often they are used above."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return rows.select(*keep, F.inline(F.array(made)))


def transform(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM
) -> DataFrame:
    """A row for each of ``docs``: ``doc_id``, ``n`` (units), ``form`` (plain, psm or spm),
    ``prefix_chars`` and ``middle_chars`` (code points; null if plain) and ``output``.

    Null texts are empty; empty texts and texts with a sentinel stay plain. The cuts and the form
    depend on the doc_id alone, so repeated rows are cut alike; a null doc_id counts as the empty
    string. Equal cuts leave the middle empty. Further columns are ignored; an empty table gives
    an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    rows = _named(
        docs,
        [],
        doc_id=doc_id,
        text=text,
        n=F.regexp_count(text, F.lit(UNIT)).cast("long"),
        digest=F.sha2(key, 256),
    )
    draws = [
        F.conv(F.substr("digest", F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("long")
        for k in range(4)
    ]
    cuts = [draw % (F.col("n") + 1) for draw in draws[:2]]
    held = F.contains("text", F.lit(PREFIX))
    for sentinel in (SUFFIX, MIDDLE):
        held |= F.contains("text", F.lit(sentinel))
    plain = (F.col("text") == "") | held | (draws[2] % 100 >= rate)
    rows = _named(
        rows,
        ["doc_id", "text", "n"],
        a=F.least(*cuts),
        b=F.greatest(*cuts),
        form=F.when(plain, "plain").when(draws[3] % 100 < spm, "spm").otherwise("psm"),
    )
    pattern = F.format_string(
        rf"(?s)\A({_UNIT}{{%d}}+)({_UNIT}{{%d}}+)(.*+)", F.col("a"), F.col("b") - F.col("a")
    )
    order = F.when(F.col("form") == "psm", _ORDER["psm"]).otherwise(_ORDER["spm"])
    changed = F.col("form") != "plain"
    output = F.when(changed, F.regexp_replace("text", pattern, order)).otherwise(F.col("text"))
    rows = _named(rows, ["doc_id", "n", "form"], output=output)
    rows = _named(
        rows,
        ["doc_id", "n", "form", "output"],
        parts=F.when(F.col("form") != "plain", _parts(F.col("output"))),
    )
    prefix = F.when(F.col("form") == "psm", F.get("parts", F.lit(0))).otherwise(
        F.get("parts", F.lit(1))
    )
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.length(prefix).cast("long").alias("prefix_chars"),
        F.length(F.get("parts", F.lit(2))).cast("long").alias("middle_chars"),
        "output",
    )
