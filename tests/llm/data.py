"""Small tables with the awkward cases: nulls, empty and long texts, copies, clashing columns."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, kept int, key double, size string, shard string, score string, n_tokens string, serial int, component string")
LEX = {
    "en": "the of and that ing tion with house water think other would there people first under night".split(),
    "de": "der die und nicht eine schule wasser haus denken andere würde leute zuerst unter nacht über".split(),
    "fr": "le la les dans une maison eau penser autre serait gens première sous nuit être avec".split(),
}


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    out = []
    for i in range(n):
        w = "".join(rng.choice(LEX[lang]) for _ in range(rng.choice((1, 1, 2))))
        out.append(w.capitalize() + "." if i % 9 == 8 else w)
    return " ".join(out)


def rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    texts: list[tuple[str | None, str | None]] = [
        (None, None), ("", "en"), (" \n\t ", "de"), ("one", "en"), ("One", None), ("#$% 12 34", "en"), ("a b c d", "en"), ("A b  c\nd", "fr"),
        ("<|endoftext|> </s> [INST] x", "en"), ("中文 ünï 😀  double  spaces \n\n end ", "fr"), ("x" * 5000, "en")]
    for lang in LEX:
        texts += [(prose(rng, rng.randint(60, 160), lang), lang) for _ in range(14)]
    base = prose(rng, 150)
    texts += [(base, "en")] * 40                       # a large group of copies
    for _ in range(25):                                # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = "changed" + str(rng.randrange(9999))
        texts.append((" ".join(w), "en"))
    passage = prose(rng, 60)
    texts += [(prose(rng, 40) + " " + passage + " " + prose(rng, 40), "en") for _ in range(12)]
    texts.append(("same line of words here\n" * 60, "en"))
    texts.append((prose(rng, 9000), "en"))             # a very long document
    out = [(i, t, lang, None if i % 5 == 0 else f"s{i % 3}", None if i % 7 == 0 else len(t or ""),
            "x", 1, 0.5, "y", "z", "s", "n", i, "c") for i, (t, lang) in enumerate(texts)]
    return out


def frame(spark, data: list[tuple] | None = None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def row_groups(folder: str) -> list[int]:
    """Rows of every row group of the Parquet files in a local folder."""
    from pathlib import Path

    import pyarrow.parquet as pq
    found = [pq.ParquetFile(p).metadata for p in Path(re.sub(r"^file:(//)?", "", folder)).glob("*.parquet")]
    return [m.row_group(i).num_rows for m in found for i in range(m.num_row_groups)]
