"""Ingest and cleaning of JSON Lines readings (parse, validate, correct, audit, dedup).

Everything here but :func:`land_outputs` is a lazy ``DataFrame -> DataFrame`` function built from
Catalyst expressions; the only shuffle is the deduplication aggregate. ``land_outputs`` parses the
lines once and writes what they are (valid, dropped, broken, logged events) as partitions of one
table, from which :class:`Outputs` answers the cleaner, the audit log and the statistics.

Input shapes
------------
* *lines*: ``value`` (text) and ``_ord`` (any orderable column giving input order),
  as returned by :func:`plume.sources.text.read_jsonl`.
* *records*: ``_ord``, the five record fields as text and ``_has_<field>`` flags
  telling "key present" apart from "key absent" (a JSON ``null`` is present).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume import rules
from plume.schemas import ingest_schema
from plume.functions.columns import iso_timestamp_text, measure_text_value

_BLANKS = " \t\r\n\f\u000b"

# Line kinds
BLANK = "blank"
COMMENT = "comment"
PARSE_ERROR = "parse_error"
RECORD = "record"

# Drop reasons, in the order the rules are checked
MISSING_REQUIRED = "missing_required"
BAD_TIMESTAMP = "bad_timestamp"
BAD_PRESSURE = "bad_numeric_chamber_pressure"
BAD_FUEL = "bad_numeric_fuel_flow"
BAD_TEMPERATURE = "bad_numeric_temperature"
BELOW_ABSOLUTE_ZERO = "below_absolute_zero"
DROP_REASONS = (MISSING_REQUIRED, BAD_TIMESTAMP, BAD_PRESSURE, BAD_FUEL, BAD_TEMPERATURE,
                BELOW_ABSOLUTE_ZERO)

# Audit rules (one row per logged event)
NEGATIVE_PRESSURE_CORRECTED = "negative_pressure_corrected"
ZERO_FUEL_CORRECTED = "zero_fuel_corrected"
HIGH_TEMPERATURE = "high_temperature_warning"
DUPLICATE_REMOVED = "duplicate_removed"


def emit_rows(df: DataFrame, cond: Column, *cols) -> DataFrame:
    """The ``cols`` of the rows of ``df`` where ``cond`` holds, produced by a generator.

    A plain ``where`` on a column derived from the JSON parse is pushed by
    Catalyst below the projections that compute it, so the filter gets its own
    copies of the parse and the validation. Rows that come out of ``inline``
    are generator output: no filter on them can move below the generator, and
    the parse stays single.
    """
    named = [F.col(c) if isinstance(c, str) else c for c in cols]
    picked = F.filter(F.array(F.when(cond, F.struct(*named))), lambda x: x.isNotNull())
    return df.select(F.inline(picked))


def classify_lines(lines: DataFrame) -> DataFrame:
    """Strip lines, mark blank/comment lines, parse JSON strictly.

    Adds ``line`` (stripped text), ``kind`` and ``doc`` (``map<string,string>`` of
    a JSON object, NULL otherwise).

    A line starting with ``{`` is parsed once, wrapped as ``[line]`` into
    ``array<map<string,string>>``: inside the brackets trailing text, a second
    object without a comma, single quotes or NaN make the whole parse fail, and
    a comma-separated second object gives two elements. It is an object line when
    exactly one element parses and the line ends with ``}``. Any other line is
    probed with ``json_array_length``: exactly one JSON value that is not an
    object is a record without keys (later dropped), everything else a parsing
    error.
    """
    opts = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    stripped = lines.select("_ord", F.btrim(F.col("value"), F.lit(_BLANKS)).alias("line"))
    line = F.col("line")
    wrapped = F.concat(F.lit("["), line, F.lit("]"))
    is_brace = line.startswith("{")
    stripped = (stripped
                .withColumn("_objs", F.when(is_brace, F.from_json(wrapped, "array<map<string,string>>", opts)))
                .withColumn("_nvalues", F.when(~is_brace & (line != "") & ~line.startswith("#"),
                                               F.json_array_length(wrapped))))
    objs = F.col("_objs")
    is_object = (F.size(objs) == 1) & objs.getItem(0).isNotNull() & line.endswith("}")
    is_scalar = F.col("_nvalues") == 1
    kind = (F.when(line == "", BLANK)
            .when(line.startswith("#"), COMMENT)
            .when(F.coalesce(is_object, F.lit(False)), RECORD)
            .when(F.coalesce(is_scalar, F.lit(False)), RECORD)
            .otherwise(PARSE_ERROR))
    return (stripped.withColumn("kind", kind)
            .select("_ord", "line", "kind",
                    F.when(F.col("kind") == RECORD, objs.getItem(0)).alias("doc")))


def records_from_lines(classified: DataFrame, keep_line: bool = False) -> DataFrame:
    """Records (text fields + presence flags) for every line of ``classify_lines``.

    Lines that are not records keep their kind in ``_kind`` (``validate`` turns it
    into the status), instead of being filtered out here: a filter on a derived
    column would be pushed below the parse and make Spark parse each line twice.
    """
    cols = [F.col("_ord"), F.col("kind").alias("_kind")] + ([F.col("line").alias("_line")] if keep_line else [])
    for field in rules.CSV_COLUMNS:
        cols.append(F.col("doc").getItem(field).alias(field))
        cols.append(F.coalesce(F.map_contains_key("doc", F.lit(field)), F.lit(False))
                    .alias(f"_has_{field}"))
    return classified.select(*cols)


def _values(df: DataFrame) -> DataFrame:
    return df.select("*", *[measure_text_value(F.col(f)).alias(f"_v_{f}") for f in rules.MEASURE_FIELDS])


def validate(records: DataFrame) -> DataFrame:
    """Add ``_status`` (NULL = valid, else the first failing rule),
    ``_corrected`` and the corrected measure texts.

    Rule order: required keys present; ISO timestamp; then per measure in the
    order pressure, fuel flow, temperature: a present value must be a finite
    number; temperature below absolute zero drops the record.
    """
    df = _values(records)
    vp, vf, vt = F.col("_v_chamber_pressure"), F.col("_v_fuel_flow"), F.col("_v_temperature")
    bad = {f: F.col(f"_has_{f}") & F.col(f"_v_{f}").isNull() for f in rules.MEASURE_FIELDS}
    first = (F.when(F.col("_kind") != RECORD, F.col("_kind")) if "_kind" in records.columns
             else F.when(F.lit(False), F.lit(None).cast("string")))
    status = (
        first.when(~(F.col("_has_timestamp") & F.col("_has_engine_id")), MISSING_REQUIRED)
        .when(iso_timestamp_text(F.col("timestamp")).isNull(), BAD_TIMESTAMP)
        .when(bad["chamber_pressure"], BAD_PRESSURE)
        .when(bad["fuel_flow"], BAD_FUEL)
        .when(bad["temperature"], BAD_TEMPERATURE)
        .when(vt < F.lit(rules.ABSOLUTE_ZERO), BELOW_ABSOLUTE_ZERO)
    )
    neg_p = F.coalesce(vp < 0, F.lit(False))
    zero_f = F.coalesce(vf == 0, F.lit(False))
    corrected = {
        "chamber_pressure": F.when(neg_p, F.regexp_replace(F.btrim("chamber_pressure", F.lit(_BLANKS)), "^-", ""))
        .otherwise(F.col("chamber_pressure")),
        "fuel_flow": F.when(zero_f, F.lit(rules.MIN_FUEL_FLOW)).otherwise(F.col("fuel_flow")),
    }
    with_status = df.select("*", status.alias("_status"))
    return with_status.select(
        *[corrected[c].alias(c) if c in corrected else F.col(c) for c in with_status.columns],
        (F.col("_status").isNull() & (neg_p | zero_f)).alias("_corrected"))


def valid_records(validated: DataFrame) -> DataFrame:
    """Only the valid records (for diagnostics; the pipeline itself never filters
    before deduplicating, see ``dedup_first``)."""
    return emit_rows(validated, F.col("_status").isNull(), *validated.columns)


def dedup_first(records: DataFrame, order_col: str = "_ord") -> DataFrame:
    """One record per raw ``(timestamp, engine_id)`` text, the first valid one
    in input order.

    Invalid records (``_status`` not NULL) take part with a NULL ordering value,
    which ``min_by`` ignores; keys with no valid record are removed *after* the
    aggregate. Filtering first would let the optimizer push the validation
    expressions below the parse and evaluate them twice. ``min_by`` is combined
    map-side, so a key with a huge number of copies is reduced inside every input
    partition before the shuffle.
    """
    order = F.col(order_col)
    valid = F.lit(True)
    if "_status" in records.columns:
        valid = F.col("_status").isNull()
        order = F.when(valid, order)
    payload = [c for c in records.columns
               if c not in ("timestamp", "engine_id", "_kind") and not c.startswith(("_has_", "_v_"))
               and c not in ("_status", "_corrected")]
    # The struct buffer of min_by needs a sort-based aggregate. Timestamp texts share
    # their first bytes, which defeats the sort's 8-byte key prefix; a leading
    # 64-bit hash of the key (same groups, the texts still decide equality)
    # gives the sort a prefix that separates almost every pair.
    key_hash = F.xxhash64("timestamp", "engine_id").alias("_key_hash")
    firsts = (records.groupBy(key_hash, "timestamp", "engine_id")
              .agg(F.min_by(F.struct(*payload), order).alias("_first"),
                   F.count_if(valid).alias("_copies")))
    return firsts.where(F.col("_copies") > 0).select("timestamp", "engine_id", "_first.*", "_copies")


def clean_output(deduped: DataFrame) -> DataFrame:
    """The five CSV columns, absent values as NULL."""
    return deduped.select(*rules.CSV_COLUMNS)


def _event(cond: Column, step: int, rule: str, field: str | None, old: Column | None,
           new: Column | None) -> Column:
    return F.when(cond, F.struct(
        F.lit(step).alias("step"), F.lit(rule).alias("rule"),
        F.lit(field).cast("string").alias("field"),
        (old if old is not None else F.lit(None)).cast("string").alias("old_value"),
        (new if new is not None else F.lit(None)).cast("string").alias("new_value")))


def _with_events(records: DataFrame) -> DataFrame:
    """``validate`` and ``_events``: an array of the events that the cleaner logs for each record, in its order,
    with NULL in the place of those that did not occur (filtered inside the generators that read it,
    where Catalyst cannot copy the parse into it). The array is NULL for a record that logs nothing, as most do."""
    df = validate(with_raw_measures(records))
    s = F.col("_status")
    vp, vf, vt = F.col("_v_chamber_pressure"), F.col("_v_fuel_flow"), F.col("_v_temperature")
    early = s.isin(MISSING_REQUIRED, BAD_TIMESTAMP)
    reached_f = ~F.coalesce(s.isin(MISSING_REQUIRED, BAD_TIMESTAMP, BAD_PRESSURE), F.lit(False))
    reached_t = ~F.coalesce(s.isin(MISSING_REQUIRED, BAD_TIMESTAMP, BAD_PRESSURE, BAD_FUEL),
                            F.lit(False))
    raw_p = F.col("_raw_p")
    events = F.array(
        _event(s == MISSING_REQUIRED, 1, MISSING_REQUIRED, None, None, None),
        _event(s == BAD_TIMESTAMP, 2, BAD_TIMESTAMP, "timestamp", F.col("timestamp"), None),
        _event(s == BAD_PRESSURE, 3, "bad_numeric", "chamber_pressure", raw_p, None),
        _event(~F.coalesce(early, F.lit(False)) & (vp < 0), 4, NEGATIVE_PRESSURE_CORRECTED,
               "chamber_pressure", raw_p, F.col("chamber_pressure")),
        _event(s == BAD_FUEL, 5, "bad_numeric", "fuel_flow", F.col("_raw_f"), None),
        _event(reached_f & (vf == 0), 6, ZERO_FUEL_CORRECTED, "fuel_flow", F.col("_raw_f"),
               F.col("fuel_flow")),
        _event(s == BAD_TEMPERATURE, 7, "bad_numeric", "temperature", F.col("temperature"), None),
        _event(s == BELOW_ABSOLUTE_ZERO, 8, BELOW_ABSOLUTE_ZERO, "temperature",
               F.col("temperature"), None),
        _event(reached_t & (vt > rules.HIGH_TEMPERATURE_WARNING), 9, HIGH_TEMPERATURE,
               "temperature", F.col("temperature"), None),
    )
    logs = s.isNotNull() | (vp < 0) | (vf == 0) | (vt > rules.HIGH_TEMPERATURE_WARNING)
    events = F.when(logs, events)
    with_raw = df.withColumn("_events", events)
    if "_kind" in df.columns:
        parse_error = F.array(_event(F.lit(True), 0, PARSE_ERROR, None,
                                     F.col("_line") if "_line" in df.columns else None, None))
        with_raw = with_raw.withColumn(
            "_events", F.when(F.col("_kind") == RECORD, F.col("_events"))
            .when(F.col("_kind") == PARSE_ERROR, parse_error))
    return with_raw


def audit_records(records: DataFrame) -> DataFrame:
    """C11 for records: one row per logged event, in the cleaner's order.

    Columns: ``_ord, step, rule, field, old_value, new_value`` and, where the input carries its
    line (``_line``), ``record``: the offending text. Events after the rule that drops a record
    are not logged (the cleaner returns at the drop).
    """
    line = ["_line"] if "_line" in records.columns else []
    out = _with_events(records).select("_ord", *line, F.explode(F.filter("_events", lambda x: x.isNotNull())).alias("e")).select("_ord", "e.*", *line)
    return out.withColumnRenamed("_line", "record")


def with_raw_measures(records: DataFrame) -> DataFrame:
    """Keep the uncorrected pressure/fuel texts for the audit log."""
    return records.withColumn("_raw_p", F.col("chamber_pressure")).withColumn("_raw_f", F.col("fuel_flow"))


def audit(lines: DataFrame) -> DataFrame:
    """C11: the full audit log of a lines input: parse errors, record events, duplicates.

    Parse errors and record events come from one pass over the lines; the
    duplicates need the dedup grouping (a second pass). ``Outputs.audit`` gives the
    same rows without parsing again.
    """
    records = records_from_lines(classify_lines(lines), keep_line=True)
    return audit_records(records).unionByName(_duplicate_events(duplicate_rows(validate(records))))


def _duplicate_events(dups: DataFrame) -> DataFrame:
    return dups.select("_ord", F.lit(10).alias("step"), F.lit(DUPLICATE_REMOVED).alias("rule"),
                       F.lit(None).cast("string").alias("field"),
                       F.concat_ws(" - ", "timestamp", "engine_id").alias("old_value"),
                       F.lit(None).cast("string").alias("new_value"),
                       F.lit(None).cast("string").alias("record"))


def duplicate_rows(validated: DataFrame) -> DataFrame:
    """The valid records that dedup removes (every copy but the first of a key):
    ``(timestamp, engine_id, _ord)``.

    The firsts are found by grouping, which combines copies map-side and takes NULL keys as
    equal; the others are then told apart by their place in the input. That place is unique,
    so a key with a third of all lines does not meet in one task.
    """
    return _later_copies(emit_rows(validated, F.col("_status").isNull(), "timestamp", "engine_id", "_ord"))


def _later_copies(valid: DataFrame) -> DataFrame:
    firsts = valid.groupBy("timestamp", "engine_id").agg(F.min("_ord").alias("_ord")).select("_ord")
    return valid.join(firsts, "_ord", "left_anti").select("timestamp", "engine_id", "_ord")


def clean_records(records: DataFrame) -> DataFrame:
    """Records -> cleaned, deduplicated CSV-shaped rows."""
    return clean_output(dedup_first(validate(records)))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Lines -> cleaned, deduplicated CSV-shaped rows."""
    return clean_records(records_from_lines(classify_lines(lines)))


def summary_from_lines(lines: DataFrame) -> DataFrame:
    """One row of run statistics.

    ``total_records`` counts lines that are valid JSON (blank/comment lines and
    parsing errors excluded); ``valid_records`` is before dedup;
    ``dropped = total - valid``; ``corrected`` counts surviving records only;
    ``duplicate_records = valid - distinct keys``. Rates are exact, 1 decimal,
    half-up, NULL when total is 0. One pass over the lines, no filter.
    """
    return _summary(validate(records_from_lines(classify_lines(lines))))


def _summary(validated: DataFrame) -> DataFrame:
    """One pass over the lines: counts per dedup key (partial aggregation; lines
    that are not records share the NULL key), then totals over the keys."""
    kind = F.col("_kind") if "_kind" in validated.columns else F.lit(RECORD)
    valid = F.col("_status").isNull()
    per_key = validated.groupBy("timestamp", "engine_id").agg(
        F.count_if(kind == RECORD).alias("n_rec"),
        F.count_if(kind == PARSE_ERROR).alias("n_err"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(valid & F.col("_corrected")).alias("n_corr"))
    out = per_key.agg(
        F.coalesce(F.sum("n_rec"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum("n_err"), F.lit(0)).cast("bigint").alias("parsing_errors"),
        F.coalesce(F.sum("n_valid"), F.lit(0)).cast("bigint").alias("valid_records"),
        F.coalesce(F.sum("n_corr"), F.lit(0)).cast("bigint").alias("corrected_records"),
        F.coalesce(F.sum(F.greatest(F.col("n_valid") - 1, F.lit(0))), F.lit(0)).cast("bigint")
        .alias("duplicate_records"))
    total = F.col("total_records")

    def rate(n: Column) -> Column:
        return F.when(total > 0, F.round(n.cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)"), 1)
                      .cast("decimal(5,1)"))

    return out.select(
        "total_records", "valid_records",
        (total - F.col("valid_records")).alias("dropped_records"),
        "corrected_records", "duplicate_records", "parsing_errors",
        rate(F.col("valid_records")).alias("success_rate_percent"),
        rate(F.col("valid_records") - F.col("duplicate_records")).alias("output_rate_percent"),
        (F.col("valid_records") - F.col("duplicate_records")).alias("unique_records"),
    )


def drop_reasons(lines: DataFrame) -> DataFrame:
    """The dropped records with the rule that dropped them (``_ord``, ``reason``)."""
    recs = validate(records_from_lines(classify_lines(lines)))
    return emit_rows(recs, (F.col("_kind") == RECORD) & F.col("_status").isNotNull(),
                     "_ord", F.col("_status").alias("reason"))


# ------------------------------------------------------------------ one parse, all outputs

# Partitions of the table that ``land_outputs`` writes
VALID, DROPPED, BROKEN, EVENT = "valid", "dropped", "broken", "event"


def classified_rows(lines: DataFrame) -> DataFrame:
    """Every row that a lines input gives, from one parse (``schemas.ingest_schema``), told apart by ``output``:

    * ``valid``: a valid record, corrected, with ``corrected``; duplicates still in;
    * ``dropped``: a rejected record with its rule and its line;
    * ``broken``: the logged event of a line that does not parse;
    * ``event``: any other event the cleaner logs for a record (C11), but the removed duplicates.

    Blank and comment lines give none. A record gives one ``valid`` or ``dropped`` row and a row per event.
    """
    df = _with_events(records_from_lines(classify_lines(lines), keep_line=True))
    types = {f.name: f.dataType for f in ingest_schema(lines.schema["_ord"].dataType).fields}

    def row(**cols) -> Column:
        return F.struct(*[cols.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()])

    record, valid = F.col("_kind") == RECORD, F.col("_status").isNull()
    kept = F.when(record, F.array(
        F.when(valid, row(output=F.lit(VALID), _ord=F.col("_ord"), corrected=F.col("_corrected"),
                          **{c: F.col(c) for c in rules.CSV_COLUMNS}))
        .otherwise(row(output=F.lit(DROPPED), _ord=F.col("_ord"), rule=F.col("_status"), record=F.col("_line")))))
    logged = F.transform(F.filter("_events", lambda x: x.isNotNull()), lambda e: row(
        output=F.when(e["rule"] == PARSE_ERROR, BROKEN).otherwise(EVENT), _ord=F.col("_ord"), record=F.col("_line"),
        **{c: e[c] for c in ("step", "rule", "field", "old_value", "new_value")}))
    return df.select(F.inline(F.when(F.col("_events").isNull(), kept).when(record, F.concat(kept, logged)).otherwise(logged)))


def land_outputs(lines: DataFrame, path: str) -> "Outputs":
    """Parse ``lines`` once and write ``classified_rows`` to ``path``, a folder per ``output``."""
    classified_rows(lines).write.mode("overwrite").partitionBy("output").parquet(path)
    return Outputs(lines.sparkSession, path, lines.schema["_ord"].dataType)


class Outputs:
    """The cleaner, the audit log and the statistics of lines that were parsed once.

    Each method reads the partitions and columns that it needs of the table at ``path`` (in the
    shared folder, so a lost executor costs a read and not a parse) and gives the rows of the
    function of the same name over lines. ``ord_type`` is the type of the lines' ``_ord``.
    """

    def __init__(self, spark, path: str, ord_type):
        self.rows = spark.read.schema(ingest_schema(ord_type)).parquet(path)

    def _of(self, *outputs: str) -> DataFrame:
        return self.rows.where(F.col("output").isin(*outputs))

    def deduplicated(self) -> DataFrame:
        """The first valid record per key, with ``_ord`` and ``_copies``."""
        return dedup_first(self._of(VALID).select("_ord", *rules.CSV_COLUMNS))

    def clean(self) -> DataFrame:
        """The cleaned, deduplicated CSV-shaped rows (``clean_lines``)."""
        return clean_output(self.deduplicated())

    def drop_reasons(self) -> DataFrame:
        return self._of(DROPPED).select("_ord", F.col("rule").alias("reason"))

    def dropped(self) -> DataFrame:
        """The rejected lines with the rule that rejected each."""
        return self._of(DROPPED).select("_ord", F.col("rule").alias("reason"), "record")

    def parse_errors(self) -> DataFrame:
        return self._of(BROKEN).select("_ord", F.col("rule").alias("kind"))

    def audit(self) -> DataFrame:
        """C11: parse errors, record events and removed duplicates."""
        events = self._of(EVENT, BROKEN).select("_ord", "step", "rule", "field", "old_value", "new_value", "record")
        return events.unionByName(_duplicate_events(_later_copies(self._of(VALID).select("timestamp", "engine_id", "_ord"))))

    def summary(self) -> DataFrame:
        """One row of run statistics (``summary_from_lines``)."""
        valid = F.col("output") == VALID
        return _summary(self._of(VALID, DROPPED, BROKEN).select(
            "timestamp", "engine_id", F.when(F.col("output") == BROKEN, PARSE_ERROR).otherwise(RECORD).alias("_kind"),
            F.when(~valid, F.col("output")).alias("_status"), F.coalesce("corrected", F.lit(False)).alias("_corrected")))


def observed_clean(lines: DataFrame):
    """C13 without an extra pass: the cleaned rows plus two ``Observation``s.

    The counters ride along the action that consumes the result (typically the
    CSV write): ``before`` sees every line once (kinds, validity, corrections),
    ``after`` counts the deduplicated rows. Read them with
    :func:`summary_from_observations` once the action has run.
    """
    from pyspark.sql import Observation

    before, after = Observation("plume_ingest_lines"), Observation("plume_ingest_output")
    validated = validate(records_from_lines(classify_lines(lines)))
    valid = F.col("_status").isNull()
    observed = validated.observe(
        before,
        F.count_if(F.col("_kind") == RECORD).alias("total_records"),
        F.count_if(F.col("_kind") == PARSE_ERROR).alias("parsing_errors"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(valid & F.col("_corrected")).alias("corrected_records"))
    out = clean_output(dedup_first(observed)).observe(after, F.count(F.lit(1)).alias("unique_records"))
    return out, before, after


def summary_from_observations(before, after) -> dict:
    """The C13 statistics from the observations of :func:`observed_clean`."""
    b, a = before.get, after.get
    total, valid = b["total_records"], b["valid_records"]
    unique = a["unique_records"]

    def rate(n):
        if not total:
            return None
        from decimal import ROUND_HALF_UP, Decimal
        return (Decimal(n) * 100 / Decimal(total)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)

    return {"total_records": total, "valid_records": valid, "dropped_records": total - valid,
            "corrected_records": b["corrected_records"], "duplicate_records": valid - unique,
            "parsing_errors": b["parsing_errors"], "success_rate_percent": rate(valid),
            "output_rate_percent": rate(unique), "unique_records": unique}
