"""Fill-in-middle: a text cut in three at token ends and written in another order.

The ends of a text's tokens form a set in containers with cumulative cardinalities
(:mod:`quizloom.llm.boundaries`). How many tokens the text has is the set's size, and
each cut is one select: find the container, then the member in it. Cuts and form follow
from a hash of seed and ``doc_id`` alone, so a task that is run again does the same.

Cutting is one pass over the texts without a shuffle. Python sees ``doc_id`` and ``text``
and returns numbers; outputs are put together by column functions.

Defined results: NULL text is the empty text, which stays plain. A NULL ``doc_id`` counts
as the empty string in the hash. A text that contains a marker stays plain, so an output
can always be taken apart again. Repeated rows are treated alike. Other columns stay;
columns of the input with a name of a result column are replaced.
"""

from hashlib import sha256
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.boundaries import CONTAINER, BoundarySet
from quizloom.llm.text import SPACES, free_name, others, quoted

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")

_IS_SPACE = np.zeros(128, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True


def _spaces(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _IS_SPACE[np.minimum(codes, 127)] & (codes < 128)


def token_ends(text: str) -> BoundarySet:
    """Positions of the last characters of all tokens.

    A token is a word with the white space before it; white space at the end of the text
    is a token of its own. The text is read one container's range at a time.
    """
    ends = BoundarySet()
    for key, at in enumerate(range(0, len(text), CONTAINER)):
        # One character more shows whether the last one ends a token.
        space = _spaces(text[at : at + CONTAINER + 1])
        last = at + len(space) == len(text) and len(space) <= CONTAINER
        word_ends = ~space[:-1] & space[1:]
        if last:
            word_ends = np.append(word_ends, True)
        ends.add(key, np.flatnonzero(word_ends[:CONTAINER]))
    return ends


def cut_offset(ends: BoundarySet, tokens: int) -> int:
    """Code points of the first ``tokens`` tokens."""
    return ends.select(tokens - 1) + 1 if tokens else 0


def _cut(doc_id: str, text: str, seed: int, fim: int, spm: int):
    """``n, form, prefix_chars, middle_chars`` of one document."""
    ends = token_ends(text)
    n = len(ends)
    digest = sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[at : at + 8], 16) for at in range(0, 32, 8))
    if not text or h3 % 100 >= fim or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    start, end = cut_offset(ends, low), cut_offset(ends, high)
    return n, "spm" if h4 % 100 < spm else "psm", start, end - start


def _cuts(seed: int, fim: int, spm: int):
    kind = "STRUCT<n: BIGINT, form: STRING, prefix_chars: BIGINT, middle_chars: BIGINT>"
    types = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}

    @F.arrow_udf(kind)
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            rows = [
                _cut(i.as_py() or "", t.as_py() or "", seed, fim, spm) for i, t in zip(ids, texts)
            ]
            columns = zip(*rows) if rows else [[]] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types.values())]
            yield pa.StructArray.from_arrays(arrays, names=list(types))

    return cuts.asNondeterministic()


def fill_in_middle(
    documents: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``documents`` with ``n`` tokens, ``form``, both lengths and the ``output`` text.

    Of the texts that can be cut, ``fim_percent`` are, and ``spm_percent`` of those with
    the suffix first.
    """
    held = free_name(documents, "cuts")
    cuts = _cuts(seed, fim_percent, spm_percent)
    found = documents.withColumn(held, cuts(F.col("doc_id").cast("string"), F.col("text")))
    cut = F.col(quoted(held))
    text = F.coalesce("text", F.lit(""))
    start, end = cut["prefix_chars"].cast("int"), (cut["prefix_chars"] + cut["middle_chars"]).cast("int")
    prefix = F.substring(text, F.lit(1), start)
    middle = F.substring(text, start + 1, cut["middle_chars"].cast("int"))
    # At least as long as what is left.
    suffix = F.substring(text, end + 1, F.length(text))
    output = (
        F.when(cut["form"] == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(cut["form"] == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    numbers = [cut[name].alias(name) for name in RESULTS[:-1]]
    return found.select(*others(documents, *RESULTS), *numbers, output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text from which an output was made.

    No text that was cut contains a marker, and a marker cannot begin in a text and end
    in a marker, so the three markers are the only ones there are.
    """
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )
