"""Language identification by compression.

Each language has a Zstandard raw-content dictionary made of labelled texts.  A
text is compressed with every dictionary, and the smallest result names its
language; where the second smallest is nearly as small, the answer is rejected.

The dictionaries are a bounded sample: of each language the ``SAMPLE`` labelled
documents that come first in an order set by a hash of their id, at most ``PIECE``
code points of each, so at most 128 K code points per language.  Everything else
covers whole texts: a text is compressed in blocks of ``BLOCK`` bytes, so that the
dictionary helps in all parts of it alike.
"""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 256
PIECE = 512
BLOCK = 1024
LEVEL = 9
MIN_MATCH = 4  # bytes a match has at least: syllables count
MARGIN = 0.01  # of the second size, that the smallest must be smaller by
LETTER = regex.compile(r"\p{L}")
MARKS = regex.compile(r"[^\w\s]+")  # punctuation tells no language


def sample_texts(labelled: DataFrame, sample: int = SAMPLE, piece: int = PIECE) -> dict[str, str]:
    """Dictionary text per language from ``labelled`` (doc_id, text, lang).

    Rows without language or text do not count.  Each task keeps ``sample`` rows
    per language before anything is shuffled; the driver gets only the sample."""
    order = [F.md5(F.concat(F.lit("lang-3:"), F.col("doc_id").cast("string"))), F.col("doc_id"), F.md5("text")]
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select(
        "lang", F.left("text", F.lit(piece)).alias("piece"), F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("place")
    )
    found = rows.where(F.col("place") <= sample).collect()
    texts: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["place"])):
        texts.setdefault(row["lang"], []).append(row["piece"])
    return {lang: "\n".join(pieces) for lang, pieces in texts.items()}


def plain(text: str) -> bytes:
    """What is compressed of a text: lower case, without marks."""
    return MARKS.sub("", text.lower()).encode("utf-8", "surrogatepass")


def compressors(texts: dict[str, str], level: int = LEVEL) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang in sorted(texts):
        how = zstandard.ZstdCompressionParameters.from_level(level, min_match=MIN_MATCH, write_content_size=False, write_dict_id=False)
        content = zstandard.ZstdCompressionDict(plain(texts[lang]), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=how)
        made.append((lang, zstandard.ZstdCompressor(dict_data=content, compression_params=how)))
    return made


def smallest(made, text: str, block: int = BLOCK) -> tuple[str, float]:
    """The language and by which share of the second size it is smaller (1 if it is
    the only one).  Ties go to the language first by code point."""
    data = plain(text)
    blocks = [data[i : i + block] for i in range(0, len(data), block)]
    sizes = sorted((sum(len(coder.compress(part)) for part in blocks), lang) for lang, coder in made)
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def identify(docs: DataFrame, texts: dict[str, str], margin: float = MARGIN, level: int = LEVEL) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row of ``docs`` (doc_id, text).

    ``score`` is the margin of the best over the second dictionary (0 to 1); a
    narrow one sets ``rejected``, and the caller decides what to do with the
    guess.  A text that is null or has no letter is ``und``, with score 0 and
    rejected, and so is every text if nothing was learned.  Repeated rows are all
    returned; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(texts)

    def run(batches):
        made = compressors(shared.value, level)
        for batch in batches:
            found = []
            for text in batch.column(1):
                text = text.as_py()
                if not made or text is None or not LETTER.search(text):
                    found.append(("und", 0.0))
                else:
                    found.append(smallest(made, text))
            scores = [score for _, score in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array([score < margin for score in scores], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id):
    """A fixed third of the documents, by the CRC-32 of the id as text."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3)) == 1, F.lit(False))
