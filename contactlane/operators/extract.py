"""Extraction of contact fields from message bodies.

Three ways in, one output shape (``EXTRACTED`` plus ``request_type``):

* :func:`extract_labelled` -- native cuts of labelled text
  (inline ``Name: ... SAP ID: ...`` or one label per line);
* :func:`extract_with` -- any user batch extractor (e.g. a model client) run
  through ``mapInPandas``; a failing row yields an error, never a failed task;
* :func:`parse_responses` -- JSON responses of an external extractor, parsed
  as VARIANT with ``try_parse_json``/``try_variant_get``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions import textops as tx
from ..functions.sqltext import ident, sql_string
from ..session import ship_package

# ---------------------------------------------------------------------------
# Field labels recognised in message bodies, and what ends a
# field's value (the next label, the closing phrase, or the end of the line).
LABELS = {
    "sap_id": r"SAP (?:Account )?ID:",
    "contact_name": r"(?:Contact )?Name:",
    "contact_email": r"(?:Contact )?Email:",
    "contact_phone": r"(?:Contact )?Phone:",
    "request_type": r"Request Type:",
}
CLOSING_PHRASE = r"Thank you"
LINE_BREAK = r"[\n\r]"
DEFAULT_REQUEST_TYPE = "account_update"
# ---------------------------------------------------------------------------

FIELDS = ("sap_id", "contact_name", "contact_email", "contact_phone")
EXTRACTION_FIELDS = FIELDS + ("request_type",)
# Error codes of the extraction stage.
NO_FIELDS = "no_labelled_fields"
NO_RESPONSE = "no_response"
BAD_RESPONSE = "unparseable_response"

_STOP = "|".join(LABELS.values()) + "|" + CLOSING_PHRASE


def label_forms(pattern: str) -> list[str]:
    """The texts a label pattern stands for: plain text with optional groups."""
    before, found, rest = pattern.partition("(?:")
    if not found:
        return [pattern]
    optional, _, after = rest.partition(")?")
    return [before + x + y for x in (optional, "") for y in label_forms(after)]


# The field of each label text, and one pattern for everything that ends a value.
LABEL_FIELDS = {form: field for field, pattern in LABELS.items() for form in label_forms(pattern)}
# The look-ahead spares the alternatives wherever no label can begin.
_BEGIN = "".join(sorted({form[0] for form in (*LABEL_FIELDS, CLOSING_PHRASE)})) + LINE_BREAK.strip("[]")
_MARK = f"(?=[{_BEGIN}])(?:{_STOP}|{LINE_BREAK})"


def parts_sql(body: str) -> str:
    """The texts between labels, closing phrases and line breaks."""
    return f"split({body}, {sql_string(_MARK)})"


def marks_sql(body: str) -> str:
    """What stands between those texts, as the names of fields (NULL for what is not
    a label): the ``i``-th comes before the text of index ``i`` (from 1)."""
    names = ", ".join(f"{sql_string(form)}, {sql_string(field)}" for form, field in LABEL_FIELDS.items())
    return (f"transform(regexp_extract_all({body}, {sql_string(_MARK)}, 0), "
            f"m -> try_element_at(map({names}), m))")


def value_sql(parts: str, marks: str, field: str) -> str:
    """The stripped text after ``field``'s first label, NULL when absent or empty."""
    at = f"CAST(nullif(array_position({marks}, {sql_string(field)}), 0) AS INT)"
    return f"nullif({tx.strip(f'get({parts}, {at})')}, '')"


def extract_struct_sql(body: str) -> str:
    """SQL of the 7-field extraction struct for one body expression. The body is taken
    apart once, whatever is read from the struct later."""
    values = {f: value_sql("x.parts", "x.marks", f) for f in EXTRACTION_FIELDS}
    found = " OR ".join(f"y.{f} IS NOT NULL" for f in FIELDS)
    pieces = f"array(named_struct('parts', {parts_sql(body)}, 'marks', {marks_sql(body)}))"
    fields = f"transform({pieces}, x -> named_struct({', '.join(f'{sql_string(f)}, {v}' for f, v in values.items())}))"
    return (f"get(transform({fields}, y -> named_struct("
            + ", ".join(f"'{f}', y.{f}" for f in FIELDS)
            + f", 'request_type', coalesce(y.request_type, {sql_string(DEFAULT_REQUEST_TYPE)})"
            + f", 'raw', {body}"
            + f", 'error', CASE WHEN {body} IS NULL THEN {sql_string(NO_RESPONSE)} "
            f"WHEN NOT ({found}) THEN {sql_string(NO_FIELDS)} END)), 0)")


def extract_labelled(df: DataFrame, body: str = "body") -> DataFrame:
    """Add the four contact fields, ``request_type`` and ``extraction_error``.

    One pass cuts the body at every label, closing phrase and line break, one
    collects what it was cut at; each field is the text after its first label.
    Nothing is retried, so long runs of blanks or half labels cost no more than
    other text.
    """
    found = F.lit(False)
    for f in FIELDS:
        found = found | F.col(f"_x_{f}").isNotNull()
    error = (F.when(F.col(body).isNull(), F.lit(NO_RESPONSE))
             .when(~found, F.lit(NO_FIELDS)))
    out = df.withColumns({"_x_parts": F.expr(parts_sql(ident(body))), "_x_marks": F.expr(marks_sql(ident(body)))})
    out = out.withColumns({f"_x_{f}": F.expr(value_sql("_x_parts", "_x_marks", f)) for f in EXTRACTION_FIELDS})
    out = out.withColumns(
        {f: F.col(f"_x_{f}") for f in FIELDS}
        | {"request_type": F.coalesce(F.col("_x_request_type"), F.lit(DEFAULT_REQUEST_TYPE)),
           "extraction_error": error})
    return out.drop("_x_parts", "_x_marks", *[f"_x_{f}" for f in EXTRACTION_FIELDS])


def extracted_view(df: DataFrame, body: str = "body") -> DataFrame:
    """The extraction stage's table: id, sender, body and the fields."""
    return extract_labelled(df.select("email_id", "sender", body), body).select(
        "email_id", "sender", F.col(body).alias("email_body"), *EXTRACTION_FIELDS,
        "extraction_error")


def extraction_outcome(extracted: DataFrame) -> DataFrame:
    """Number of messages per extraction outcome (``ok`` or error code)."""
    return (extracted.groupBy(F.coalesce(F.col("extraction_error"), F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_emails")))


def parse_responses(df: DataFrame, response: str = "response",
                    error_message: str | None = None) -> DataFrame:
    """Fields of a response, JSON text or VARIANT; bad or missing JSON gives
    NULL fields and an error, never a failed query. JSON numbers come back as
    text. ``error_message`` names a column with the extractor's own error per
    row, which is kept as ``extraction_error`` where it is given."""
    variant = isinstance(df.schema[response].dataType, T.VariantType)
    parsed = F.col(response) if variant else F.try_parse_json(F.col(response))
    fields = {f: F.try_variant_get(parsed, f"$.{f}", "string") for f in EXTRACTION_FIELDS}
    fields["request_type"] = F.coalesce(fields["request_type"], F.lit(DEFAULT_REQUEST_TYPE))
    error = (F.when(F.col(response).isNull(), F.lit(NO_RESPONSE))
             .when(parsed.isNull(), F.lit(BAD_RESPONSE)))
    if error_message:
        error = F.coalesce(F.nullif(F.col(error_message), F.lit("")), error)
    return df.withColumns(fields | {"extraction_error": error})


_EXTRACTOR_OUT = T.StructType([T.StructField(f, T.StringType(), True) for f in EXTRACTION_FIELDS]
                              + [T.StructField("extraction_error", T.StringType(), True)])


def _aligned(result: pd.DataFrame, bodies: pd.Series) -> dict[str, np.ndarray]:
    """The extractor's values by field, in the order of ``bodies``: one row for each
    body, matched by the input's index; anything else is an error of the call."""
    if len(result) != len(bodies):
        raise ValueError(f"extractor returned {len(result)} rows for {len(bodies)} bodies")
    if not result.index.equals(bodies.index):
        at = result.index.get_indexer(bodies.index) if result.index.is_unique else np.array([-1])
        if (at < 0).any():
            raise ValueError("extractor returned rows with another index than its input")
        result = result.take(at)
    out = {}
    for f in _EXTRACTOR_OUT.names:
        values = result[f].to_numpy(dtype=object) if f in result else np.full(len(bodies), None)
        if values.ndim != 1:
            raise ValueError(f"extractor returned several columns {f}")
        out[f] = np.where(pd.isna(values), DEFAULT_REQUEST_TYPE if f == "request_type" else None, values)
    return out


# How much of what the groups before told of failures is kept for the next one.
MEMORY = 0.95


def _extracted(extractor: Callable[[pd.Series], pd.DataFrame], bodies: pd.Series) -> pd.DataFrame:
    """Run the extractor over all ``bodies`` at once, or where that fails, over groups
    from the first row on. A failing group is halved until its first failing row is
    alone; what is behind that row goes to the next groups, which are as large as
    failures were apart. So a failing row costs about as many calls as it takes to
    find it among its neighbours, however many rows fail."""
    parts: list[dict[str, np.ndarray]] = []
    error = None

    def call(a: int, b: int) -> bool:
        nonlocal error
        own = bodies.iloc[a:b].reset_index(drop=True)
        try:
            parts.append(_aligned(extractor(own), own))
        except Exception as exc:  # noqa: BLE001 - reported per row
            error = f"{type(exc).__name__}: {exc}"
            return False
        return True

    done, n, seen, failed = 0, len(bodies), 0.0, 0.0
    while done < n:
        size = n if failed == 0 else max(1, int(0.7 * seen / failed))
        start, end = done, min(n, done + size)
        if call(done, end):
            done, bad = end, 0
        else:
            alone = end - done == 1  # whether the last call was for the first row alone
            while end - done > 1:
                middle = (done + end) // 2
                if call(done, middle):
                    done, alone = middle, False
                else:
                    end, alone = middle, middle - done == 1
            bad = 0 if not alone and call(done, end) else 1
            if bad:
                parts.append({f: np.array([error if f == "extraction_error" else None], object)
                              for f in _EXTRACTOR_OUT.names})
            done = end
        seen, failed = MEMORY * seen + done - start, MEMORY * failed + bad
        failed = failed if failed > 0.01 else 0.0
    return pd.DataFrame({f: np.concatenate([p[f] for p in parts]) for f in _EXTRACTOR_OUT.names}, dtype=object)


def call_tasks(spark: SparkSession) -> int:
    """Tasks that an extractor's calls are dealt to: not fewer than Spark deals
    shuffles to, as one call can be slow, however few bytes the bodies are."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def extract_with(df: DataFrame, extractor: Callable[[pd.Series], pd.DataFrame],
                 body: str = "body") -> DataFrame:
    """X1(b): run a batch ``extractor`` (Series of bodies -> DataFrame with
    the extraction fields) over Arrow batches of each partition.

    The extractor answers with one row per body, under the body's index (in any
    order); an ``extraction_error`` it gives for a row is kept. A call that
    fails, or answers with too few, too many or foreign rows, is repeated in
    halves and smaller groups, so only the rows at fault get ``extraction_error``
    (the exception text) and NULL fields. The rows stay in their partitions: a
    table of few files should be dealt to :func:`call_tasks` first.
    """
    out_schema = T.StructType(df.schema.fields + [f for f in _EXTRACTOR_OUT.fields
                                                  if f.name not in df.columns])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            base = pdf.reset_index(drop=True)
            if base.empty:
                continue
            fields = _extracted(extractor, base[body])
            yield pd.concat([base.drop(columns=[c for c in fields if c in base]), fields],
                            axis=1)[out_schema.names]

    ship_package(df.sparkSession)
    return df.mapInPandas(run, out_schema)


# Fixed value: an e-mail address inside free text (the e-mail rule's character
# classes, unanchored). The look-behind only lets a match start where a run of
# local-part characters starts -- the leftmost match anyway -- which keeps the
# scan linear on long runs of such characters.
ADDRESS_PATTERN = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def document_addresses(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Documents that contain e-mail addresses: how many, which (distinct,
    sorted, ``;``-joined) and how many pass the e-mail rule. Whole texts."""
    found = F.expr(f"regexp_extract_all({ident(text)}, {sql_string(ADDRESS_PATTERN)}, 0)")
    valid = F.expr(f"size(filter(_addresses, a -> {R.EMAIL.inline_valid('a')}))")
    return (docs.select(key, found.alias("_addresses")).where(F.size("_addresses") > 0)
            .select(key, F.size("_addresses").cast("long").alias("n_addresses"),
                    F.array_join(F.array_sort(F.array_distinct("_addresses")), ";").alias("addresses"),
                    valid.cast("long").alias("n_valid")))
