"""Explicit schemas of every table and file the engine reads or writes."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _row(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_LONG, _INT, _TEXT, _DOUBLE = LongType(), IntegerType(), StringType(), DoubleType()
_TEXTS = ArrayType(_TEXT)

CORPUS = _row(doc_id=_LONG, text=_TEXT)
CHUNK = _row(chunk_id=_LONG, doc_id=_LONG, text=_TEXT)
VECTOR = _row(chunk_id=_LONG, embedding=ArrayType(FloatType()))
INDEX = StructType([*CHUNK.fields, VECTOR["embedding"]])
TAXONOMY = _row(
    domain=_TEXT,
    categories=MapType(_TEXT, ArrayType(_row(topic=_TEXT, difficulty=_TEXT))),
)
STORED_LEAF = _row(domain=_TEXT, category=_TEXT, topic=_TEXT, difficulty=_TEXT, leaf_id=_TEXT)
LEAF = _row(id=_TEXT, label=_TEXT, difficulty=_TEXT, synonyms=_TEXTS)
PROMPT = _row(
    prompt_id=_TEXT,
    prompt_type=_TEXT,
    description=_TEXT,
    template=_TEXT,
    parser_regex=_TEXT,
    version=_TEXT,
    # Fields of the document that are none of the above.
    extra=MapType(_TEXT, _TEXT),
)
PASSAGE = _row(chunk_id=_LONG, doc_id=_LONG, text=_TEXT, score=_DOUBLE)
BUNDLE = _row(
    taxonomy_id=_TEXT, query_terms=_TEXTS, passages=ArrayType(PASSAGE), difficulty=_TEXT
)
QUESTION_SET = _row(taxonomy_id=_TEXT, mcqs=_TEXTS)
QUESTION = _row(file_path=_TEXT, taxonomy_id=_TEXT, pos=_INT, q_raw=_TEXT)
PARSED_MCQ = _row(question=_TEXT, options=_TEXTS, answer_text=_TEXT, answer_number=_LONG)
RESPONSE = _row(file_path=_TEXT, pos=_INT, model=_TEXT, raw=_TEXT)
STATUS = _row(taxonomy_id=_TEXT, status=_TEXT, error=_TEXT)
# Where and why a file is no document, and a YAML text as JSON or what is wrong with it.
PROBLEM = _row(place=_TEXT, reason=_TEXT)
CONVERTED = _row(text=_TEXT, place=_TEXT, reason=_TEXT)
REPLY = _row(raw=_TEXT, error=_TEXT)
PANEL_REPLIES = ArrayType(_row(model=_TEXT, raw=_TEXT))
GRADE = _row(passing=BooleanType(), score=_DOUBLE, error=_TEXT)
EMBEDDING = ArrayType(FloatType())
