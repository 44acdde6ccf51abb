"""Message bytes to text, text to document, document to flat text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from viewstar.schemas import EVENT, EVENT_FIELDS

DOCUMENT, RAW, ERROR = "doc", "raw", "error"


def configure(spark: SparkSession) -> SparkSession:
    """Let a document repeat a key (the last one counts); otherwise such text is ``raw``."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def decode_text(value) -> Column:
    """Bytes as UTF-8 text; malformed parts become U+FFFD, nothing throws."""
    return F.make_valid_utf8(_column(value).cast("string"))


def with_document(df: DataFrame, text: str = "text", name: str = "document") -> DataFrame:
    """``df`` with the text as one whole JSON value, or null, in a variant column.

    Spark's parser stops after the first value and does not mind what follows, so the
    text is parsed as the first of two array elements. The second is a hash of the text,
    which the text cannot contain by chance: it is found there only if nothing trails.
    The steps are columns of their own, as each is used twice and must not run twice.
    """
    pair = F.concat(F.lit("["), F.col(text), F.lit(","), F.col("_mark").cast("string"),
                    F.lit("]"))
    whole = F.try_variant_get("_pair", "$[1]", "bigint") == F.col("_mark")
    return (
        df.withColumn("_mark", F.xxhash64(text))
        .withColumn("_pair", F.try_parse_json(pair))
        .withColumn(name, F.when(whole, F.try_variant_get("_pair", "$[0]", "variant")))
        .drop("_mark", "_pair")
    )


def is_object(text) -> Column:
    """Whether text already known to be JSON is an object."""
    return _column(text).rlike(r"^[ \t\r\n]*\{")


def route(text, parsed) -> Column:
    """``doc`` for an object, ``raw`` for text that is no JSON, ``error`` for the rest.

    The rest is JSON that is not an object, and messages without a value.
    """
    return (
        F.when(_column(text).isNull(), ERROR)
        .when(_column(parsed).isNull(), RAW)
        .when(is_object(text), DOCUMENT)
        .otherwise(ERROR)
    )


def normalised_json(text) -> Column:
    """Valid JSON text with white space and escapes normalised and its meaning kept."""
    text = _column(text)
    nested = text.rlike(r"^[ \t\r\n]*[\[{]")
    return F.when(nested, F.get_json_object(text, "$")).otherwise(
        F.trim(F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", "")))


def event_fields(text, is_document) -> Column:
    """The fields the star schema reads, as text.

    Reading every field as STRING keeps ``1`` as ``1`` beside text in other documents
    (a fraction loses its trailing zeros, as ``1.50`` is the number ``1.5``), and gives
    nested values as JSON text. The other fields are not parsed into columns.
    """
    return F.when(_column(is_document), F.from_json(_column(text), EVENT))


def document_fields(document, names=EVENT_FIELDS) -> Column:
    """Fields of a parsed document as text, without parsing its text again.

    Numbers, nested values and nulls read as with ``event_fields``.
    """
    document = _column(document)
    return F.struct(*[
        F.try_variant_get(document, f"$.{name}", "string").alias(name) for name in names])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array, map and variant columns as JSON text; other columns as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select([
        F.to_json(field.name).alias(field.name)
        if isinstance(field.dataType, nested) else F.col(field.name)
        for field in df.schema.fields
    ])


def as_text(df: DataFrame, columns=EVENT_FIELDS, keep_nulls: bool = False) -> DataFrame:
    """Cast ``columns`` to text and turn null, and absent columns, into empty text."""
    present = set(df.columns)

    def text(name: str) -> Column:
        value = F.col(name).cast("string") if name in present else F.lit(None).cast("string")
        return value if keep_nulls else F.coalesce(value, F.lit(""))

    others = [F.col(name) for name in df.columns if name not in columns]
    return df.select(*others, *[text(name).alias(name) for name in columns])


def union_of_keys(frames: list[DataFrame]) -> DataFrame:
    """Frames with differing columns, one under the other, with the union of columns."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def document_schema(df: DataFrame, document: str) -> DataFrame:
    """One row: the schema that covers every document of a variant column."""
    return df.agg(F.schema_of_variant_agg(document).alias("schema"))
