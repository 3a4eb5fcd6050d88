"""Language identification by compression: each text is compressed once per
language with that language's zstandard raw-content dictionary; the smallest
total wins and a narrow margin rejects.

Fitting learns every label from a bounded sample: of each language the documents
that have the least hash in ``SAMPLE_DOCS`` hash buckets, ``SAMPLE_CHARS`` code
points of each. Over ``FULL_SAMPLES`` languages share what so many have (64 x 256 x
4,000 code points reach the driver at most, however large the table): first each has
fewer documents, and if not even one is left for each, fewer code points. Lines that
occur in the samples of two languages (licence lines, foreign passages) teach nothing
and are left out. Predicting reads every whole text in blocks of ``BLOCK`` bytes.

A text is seen as its lower-case words of letters, all of them in their order; what
stands between words is one blank.

Defined results: a null text or one without a letter is ``und``, score 0,
rejected; ties go to the language with more labelled rows; without any labelled row
every text is ``und``; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.session import ship_package

SAMPLE_DOCS, SAMPLE_CHARS, FULL_SAMPLES = 256, 4000, 64
LEVEL, BLOCK = 6, 4096
# A text whose best and second language differ by less (as a share of the
# second size) is rejected.
MARGIN = 0.002
# Margin at which the score is 1 - 1/e.
SCALE = 0.05
UNDETERMINED = "und"

_BETWEEN = re.compile(r"[\W\d_]+")


def running_words(text: str | None) -> str:
    return _BETWEEN.sub(" ", (text or "").lower()).strip(" ")


def held_out(id_col: str = "doc_id") -> Column:
    """The contract's third of the documents from which nothing is learned (a null identifier is not in it)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def dictionaries(samples: dict[str, list[str]]) -> dict[str, bytes]:
    """Raw dictionary content per language from sampled texts."""
    lines = {lang: dict.fromkeys(x for t in texts for line in t.split("\n") if (x := running_words(line)))
             for lang, texts in samples.items()}
    seen: dict[str, int] = defaultdict(int)
    for own in lines.values():
        for line in own:
            seen[line] += 1
    return {lang: "\n".join(x for x in own if seen[x] == 1 or len(lines) == 1).encode() for lang, own in lines.items()}


def shares(n_langs: int) -> tuple[int, int]:
    """(documents, code points of each) that each of so many languages is sampled with."""
    docs = min(SAMPLE_DOCS, max(1, FULL_SAMPLES * SAMPLE_DOCS // max(1, n_langs)))
    return docs, min(SAMPLE_CHARS, max(1, FULL_SAMPLES * SAMPLE_DOCS * SAMPLE_CHARS // max(1, n_langs * docs)))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionaries of the labelled rows given (null labels and texts are passed over)."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    lang, pick = F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.lit("sample")).alias("pick")
    docs, chars = shares(labelled.where(F.col(lang_col).isNotNull()).select(lang).distinct().count())
    # Two longs per row are aggregated; texts are read for the chosen rows only.
    pair = F.xxhash64("pick", "lang")
    chosen = known.select(lang, pick).groupBy("lang", F.pmod("pick", F.lit(docs)).alias("b")).agg(
        F.min("pick").alias("pick"), F.count("*").alias("n")).select("lang", "n", pair.alias("pair")).collect()
    count: dict[str, int] = defaultdict(int)
    for r in chosen:
        count[r["lang"]] += r["n"]
    langs = sorted(count, key=lambda k: (-count[k], k))
    pairs = sorted(r["pair"] for r in chosen)
    if not pairs:
        return {}
    rows = (known.select(lang, pick, F.substring(F.col(text_col), 1, chars).alias("t")).where(pair.isin(pairs))
            .groupBy("lang", "pick").agg(F.min("t").alias("t")).collect())
    samples: dict[str, list[str]] = {lang: [] for lang in langs}
    for r in sorted(rows, key=lambda r: (r["lang"], r["pick"])):
        samples[r["lang"]].append(r["t"])
    return dictionaries(samples)


class Classifier:
    """The compressors of one task, by falling frequency of their languages."""

    def __init__(self, content: dict[str, bytes]):
        self.langs = [x for x in content if content[x]]
        # Words are short: matches of four bytes count.
        self.compressors = [zstandard.ZstdCompressor(
            compression_params=zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(content[x]), min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False),
            dict_data=zstandard.ZstdCompressionDict(content[x], dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for x in self.langs]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)"""
        words = running_words(text)
        if not words or not self.langs:
            return UNDETERMINED, 0.0, True
        data = f" {words} ".encode()
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), k) for k, c in enumerate(self.compressors))
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        return self.langs[sizes[0][1]], 1.0 - math.exp(-margin / SCALE), margin < MARGIN


def identify(docs: DataFrame, content: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, lang_score, lang_rejected`` appended (the
    columns before are passed on as they are, whatever their names). Map-only."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for batch in parts:
            got = [model.predict(t.as_py()) for t in batch.column("row").field(text_col)]
            lang, score, rejected = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["row", "lang_pred", "lang_score", "lang_rejected"])

    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())])
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).mapInArrow(batches, schema)


def keep_identified(docs: DataFrame, learn_from: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told apart clearly."""
    return identify(docs, fit(learn_from, text_col=text_col), text_col).where(~F.col("lang_rejected")).select("row.*")
