"""Verification of a whole log: chains, checkpoints and the cross-checks between them, as rows of findings.

Entries and checkpoints are DataFrames (see ``sources.jsonl``). Everything is joins and windows; findings carry a sort
key, so a report has one order wherever its rows were computed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ed25519
from ..functions.jsonbytes import RECORD_FIELDS, canonical_record, checkpoint_payload, genesis_seed
from .chain import payload_hashes
from .stage import kept, numbered, work

# Kinds of findings.
FATAL = ("chain", "checkpoint", "tip_hash_mismatch", "entry_count_mismatch", "tip_hash_unverifiable", "duplicate_trace_segment")
ADVISORY = ("key_id_field_mismatch", "torn_trailing_line")
# The lines of a report that give its counts, and what stands after a text that was cut.
COUNTS = ("Traces processed:      {}", "Checkpoints processed: {}")
CUT = " [truncated: {} more byte(s)]"
_COLUMNS = ("phase", "k1", "k2", "k3", "trace_id", "kind", "severity", "detail")


def _finding(rows: DataFrame, phase: int, k1: Column, k2: Column, k3: Column, trace: Column, kind: Column, severity: str, detail: Column) -> DataFrame:
    return rows.select(
        F.lit(phase).alias("phase"),
        k1.cast("string").alias("k1"),
        k2.cast("long").alias("k2"),
        k3.cast("long").alias("k3"),
        trace.alias("trace_id"),
        kind.alias("kind"),
        F.lit(severity).alias("severity"),
        detail.alias("detail"),
    )


def repeated_numbers(entries: DataFrame, trace: str = "trace_id", seq: str = "seq_in_trace") -> DataFrame:
    """(trace, seq, repeats): sequence numbers that occur again in their trace, and how often."""
    return entries.groupBy(trace, seq).agg((F.count(F.lit(1)) - 1).alias("repeats")).where("repeats > 0")


def duplicate_segments(entries: DataFrame) -> DataFrame:
    """Traces in which a sequence number occurs more than once."""
    return repeated_numbers(entries).select("trace_id").distinct()


def chain_states(entries: DataFrame, public: bytes | None) -> DataFrame:
    """(trace_id, n, dup, error, tip): the first error along each chain, or its recomputed tip.

    An entry is checked for the version of its chain, its signature (if a key is given) and its stored hash. A chain is
    made serially, but checked in parallel: as long as no entry before it is wrong, the stored hash of the entry before is
    the one that recomputing the chain would give, and its version that of the chain. So every entry is compared with its
    neighbour alone, whichever task that is in, and the first entry that fails is the first that a serial check finds;
    what later ones say doesn't count. A long chain is dealt over all tasks, and without signatures all is done by Spark's
    own functions.
    """
    names = ["trace_id", "seq_in_trace", "schema_version", "entry_hash"]
    names += ["algorithm", "signature"] * (public is not None)
    made = lambda rows: rows.select(*names, genesis_seed(F.col("trace_id"), F.col("schema_version")).alias("seed"), canonical_record().alias("bytes"))
    rows = entries.select(*dict.fromkeys([*names, *RECORD_FIELDS]))
    rows = numbered(rows, "trace_id", "seq_in_trace", name="place", before=tuple(names[:4]), ties=("schema_version", "bytes", "entry_hash"), made=made)
    last = F.col("_before")
    inner = last["trace_id"].eqNullSafe(F.col("trace_id"))
    prev = F.when(inner, last["entry_hash"]).otherwise(F.col("seed"))
    payload = F.concat(F.encode("bytes", "UTF-8"), F.unhex("prev"))
    bad_sig = F.lit(None).cast("string")
    if public is not None:
        bad_sig = ed25519.verified(public, payload, F.col("algorithm"), F.col("signature"))
    flat = rows.select(
        "trace_id", "place", "schema_version", "entry_hash", "bytes", *["algorithm", "signature"] * (public is not None),
        prev.alias("prev"),
        (inner & last["seq_in_trace"].eqNullSafe(F.col("seq_in_trace"))).alias("again"),
        F.when(inner, last["schema_version"]).otherwise(F.col("schema_version")).alias("version"),
        (~inner & F.col("seed").isNull()).alias("unseeded"),
    ).withColumn("now", F.sha2(payload, 256)).withColumn("bad_sig", bad_sig)
    wrong = (
        F.when(F.col("unseeded"), F.lit("the chain has no seed: its trace_id is no hex, or its schema_version is empty"))
        .when(F.col("schema_version") != F.col("version"), F.format_string("schema_version %s in a chain of %s", "schema_version", "version"))
        .when(F.col("bad_sig").isNotNull(), F.col("bad_sig"))
        .when(~F.col("entry_hash").eqNullSafe(F.col("now")), F.format_string("stored hash %s, its content gives %s", "entry_hash", "now"))
    )
    flat = flat.withColumn("wrong", wrong)
    first = F.min(F.when(F.col("wrong").isNotNull(), F.struct("place", "wrong", "unseeded"))).alias("first")
    out = flat.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("again").alias("dup"), first, F.min("place").alias("start"), F.max_by("entry_hash", "place").alias("last"))
    at = F.when(F.col("first.unseeded"), F.lit("")).otherwise(F.concat(F.lit("entry "), (F.col("first.place") - F.col("start")).cast("string"), F.lit(": ")))
    error = F.concat(at, F.col("first.wrong"))
    return out.select("trace_id", "n", "dup", error.alias("error"), F.when(~F.col("dup") & F.col("first").isNull(), F.col("last")).alias("tip"))


def odd_key_ids(entries: DataFrame, states: DataFrame, own: str) -> DataFrame:
    """Entries of verified chains that claim another key than the one that signed them."""
    good = states.where("tip is not null").select("trace_id")
    return entries.where((F.col("key_id") != "") & (F.col("key_id") != own)).join(good, "trace_id", "left_semi")


def bad_links(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints whose link isn't the payload hash of the line before, with that as expected_prev."""
    return payload_hashes(checkpoints).where("prev_checkpoint_hash <> expected_prev")


def cross_checks(states: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(line_no, checkpoint_seq, pos, trace_id, tip_hash, entry_count, logged, tip, kind): tips of checkpoints that the
    log contradicts, one row for each kind of contradiction; a count and a tip may both be wrong."""
    named = checkpoints.select("line_no", "checkpoint_seq", F.posexplode("trace_tips").alias("pos", "t")).select("line_no", "checkpoint_seq", "pos", "t.*")
    met = named.join(states.select("trace_id", F.col("n").alias("logged"), "tip"), "trace_id", "left")
    failed = F.col("logged").isNotNull() & F.col("tip").isNull()
    logged = F.coalesce("logged", F.lit(0)).cast("long")
    count = F.when(logged != F.col("entry_count"), "entry_count_mismatch")
    tip = F.when(failed, "tip_hash_unverifiable").when(F.col("tip") != F.col("tip_hash"), "tip_hash_mismatch")
    rows = met.select("line_no", "checkpoint_seq", "pos", "trace_id", "tip_hash", "entry_count", logged.alias("logged"), "tip", F.explode(F.array(count, tip)).alias("kind"))
    return rows.where("kind is not null")


def findings(entries: DataFrame, checkpoints: DataFrame, public: bytes | None, torn: str | None = None, strict_seq: bool = False) -> DataFrame:
    """All findings, with their sort key (phase, k1, k2, k3).

    ``checkpoints`` has line_no in file order, without gaps. Without a public key signatures aren't checked (key ids
    then aren't compared either). ``strict_seq`` also reports gaps in checkpoint_seq, which by default are not looked at.
    Chain states and checkpoints are worked out once and kept.
    """
    states = kept(chain_states(entries, public))
    none, zero = F.lit(None).cast("string"), F.lit(0)
    text = lambda *c: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in c])
    word = lambda c: F.col(c).cast("string")
    parts = [
        _finding(
            states.where("dup"),
            0,
            F.col("trace_id"),
            zero,
            zero,
            F.col("trace_id"),
            F.lit("duplicate_trace_segment"),
            "fatal",
            F.lit("a seq_in_trace occurs more than once"),
        ),
        _finding(states.where("not dup and error is not null"), 0, F.col("trace_id"), zero, zero, F.col("trace_id"), F.lit("chain"), "fatal", F.col("error")),
    ]
    if public is not None:
        own = ed25519.key_id(public)
        detail = text("entry ", word("seq_in_trace"), ": claims key_id ", F.col("key_id"), f", signed by {own}")
        parts.append(
            _finding(
                odd_key_ids(entries, states, own),
                0,
                F.col("trace_id"),
                F.lit(1),
                F.col("seq_in_trace"),
                F.col("trace_id"),
                F.lit("key_id_field_mismatch"),
                "advisory",
                detail,
            )
        )
    linked = payload_hashes(checkpoints)
    bad_sig = none if public is None else ed25519.verified(public, F.encode(checkpoint_payload(), "UTF-8"), F.lit("ed25519"), F.col("signature"))
    link = F.when(F.col("prev_checkpoint_hash") != F.col("expected_prev"), text("links to ", F.col("prev_checkpoint_hash"), ", the one before is ", F.col("expected_prev")))
    wrong = linked.withColumn("bad_sig", bad_sig).withColumn("error", F.coalesce(link, F.col("bad_sig"))).where("error is not null")
    line = F.lpad(word("line_no"), 20, "0")
    seq = text("checkpoint ", word("checkpoint_seq"), ": ")
    parts.append(_finding(wrong, 1, line, zero, zero, F.lit(""), F.lit("checkpoint"), "fatal", F.concat(seq, F.col("error"))))
    if strict_seq:
        before = checkpoints.select((F.col("line_no") + 1).alias("_next"), F.col("checkpoint_seq").alias("_before"))
        gap = checkpoints.join(before, F.col("line_no") == F.col("_next"), "left").where(F.col("checkpoint_seq") != F.coalesce("_before", zero) + 1)
        parts.append(_finding(gap, 1, line, zero, F.lit(1), F.lit(""), F.lit("checkpoint"), "fatal", F.concat(seq, F.lit("its number doesn't follow the one before"))))
    told = (
        F.when(F.col("kind") == "entry_count_mismatch", text("checkpoint counts ", word("entry_count"), " entries, the log has ", word("logged")))
        .when(F.col("kind") == "tip_hash_unverifiable", text("the chain failed, so tip ", F.col("tip_hash"), " can't be compared"))
        .otherwise(text("checkpoint has tip ", F.col("tip_hash"), ", the log gives ", F.col("tip")))
    )
    last = (F.col("kind") != "entry_count_mismatch").cast("int")
    parts.append(_finding(cross_checks(states, checkpoints), 1, line, F.col("pos") + 1, last, F.col("trace_id"), F.col("kind"), "fatal", told))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if torn is not None:
        out = out.unionByName(_finding(entries.sparkSession.range(1), 2, F.lit(""), zero, zero, F.lit(""), F.lit("torn_trailing_line"), "advisory", F.lit(torn)))
    return out.orderBy("phase", "k1", "k2", "k3")


def claimed_key_ids(entries: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Distinct key ids, but empty ones, that entries or checkpoints claim."""
    return entries.select("key_id").union(checkpoints.select("key_id")).where("key_id <> ''").distinct()


def other_key_ids(entries: DataFrame, checkpoints: DataFrame, own: str) -> DataFrame:
    """Claimed key ids that aren't ``own``."""
    return claimed_key_ids(entries, checkpoints).where(F.col("key_id") != own)


def uncovered_traces(entries: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Traces of the log that no checkpoint names; for information only."""
    return entries.select("trace_id").distinct().join(checkpoints.select(F.explode("trace_tips.trace_id").alias("trace_id")), "trace_id", "left_anti")


def status_line(fatal: Column, advisory: Column) -> Column:
    return (
        F.when((fatal == 0) & (advisory == 0), F.lit("Status: OK"))
        .when(fatal == 0, F.format_string("Status: OK (%d advisory finding(s))", advisory))
        .when(advisory == 0, F.format_string("Status: FAILED (%d error(s))", fatal))
        .otherwise(F.format_string("Status: FAILED (%d fatal, %d advisory)", fatal, advisory))
    )


def summary(found: DataFrame) -> DataFrame:
    """(fatal, advisory, status): any severity but ``advisory``, null too, counts as fatal."""
    fatal = F.count_if(~F.col("severity").eqNullSafe("advisory"))
    counts = found.agg(fatal.alias("fatal"), (F.count(F.lit(1)) - fatal).alias("advisory"))
    return counts.select("fatal", "advisory", status_line(F.col("fatal"), F.col("advisory")).alias("status"))


@dataclass
class Report:
    """What a verification run prints; findings are iterated, not held twice."""

    traces: int
    checkpoints: int
    errors: list[dict]
    other_key_ids: list[str]

    def status(self) -> str:
        fatal = sum(e["Severity"] != "advisory" for e in self.errors)
        advisory = len(self.errors) - fatal
        if not fatal:
            return "Status: OK" + (f" ({advisory} advisory finding(s))" if advisory else "")
        return f"Status: FAILED ({fatal} fatal, {advisory} advisory)" if advisory else f"Status: FAILED ({fatal} error(s))"

    def text(self, most_ids: int = 10, most_bytes: int = 128) -> str:
        out = [COUNTS[0].format(self.traces), COUNTS[1].format(self.checkpoints), self.status()]
        out += [f"  [{label(e['TraceID'], e['Kind'])}] {e['Kind']} ({e['Severity']}): {e['Detail']}" for e in self.errors]
        out += Report(0, 0, [], self.other_key_ids[:most_ids]).notes(len(self.other_key_ids), most_bytes)
        return "\n".join(out) + "\n"

    def notes(self, many: int, most_bytes: int) -> list[str]:
        """Lines on the first of ``many`` other key ids."""
        if not many:
            return []
        shown = [f"  {quoted(k, most_bytes)}" for k in self.other_key_ids]
        more = [f"  and {many - len(shown)} more"] * (many > len(shown))
        return [f"The log claims {many} key_id value(s) beside that of the given key:", *shown, *more]

    def json(self) -> str:
        out = {"TracesProcessed": self.traces, "CheckpointsProcessed": self.checkpoints, "Errors": self.errors or None}
        if self.other_key_ids:
            out["OtherClaimedKeyIDs"] = self.other_key_ids
        return json.dumps(out, indent=2)


def label(trace_id: str, kind: str) -> str:
    return trace_id or ("audit log" if kind == "torn_trailing_line" else "checkpoint")


def label_column(trace_id: Column, kind: Column) -> Column:
    """``label`` of rows of findings."""
    return F.when(trace_id != "", trace_id).when(kind == "torn_trailing_line", "audit log").otherwise("checkpoint")


# Short escapes of a quoted text; other characters outside printable ASCII are written by their numbers.
_SHORT = {7: "\\a", 8: "\\b", 9: "\\t", 10: "\\n", 11: "\\v", 12: "\\f", 13: "\\r", 34: '\\"', 92: "\\\\"}


def quoted(text: str, most: int) -> str:
    """Untrusted text as an ASCII literal of at most ``most`` bytes, cut between characters, and what was left out."""
    raw = text.encode("utf-8", "surrogatepass")
    cut = raw[:most].decode("utf-8", "ignore") if len(raw) > most else text
    out = []
    for c in map(ord, cut):
        plain = chr(c) if 32 <= c < 127 else f"\\x{c:02x}" if c < 128 else f"\\u{c:04x}" if c < 1 << 16 else f"\\U{c:08x}"
        out.append(_SHORT.get(c, plain))
    rest = len(raw) - len(cut.encode("utf-8", "surrogatepass"))
    return f'"{"".join(out)}"' + (CUT.format(rest) if rest else "")


def report(entries: DataFrame, checkpoints: DataFrame, public: bytes, torn: str | None = None) -> Report:
    found = findings(entries, checkpoints, public, torn)
    errors = [{"TraceID": r.trace_id, "Kind": r.kind, "Detail": r.detail, "Severity": r.severity} for r in found.toLocalIterator()]
    ids = sorted(r.key_id for r in other_key_ids(entries, checkpoints, ed25519.key_id(public)).toLocalIterator())
    return Report(entries.select("trace_id").distinct().count(), checkpoints.count(), errors, ids)


def report_lines(found: DataFrame) -> DataFrame:
    """(phase, k1, k2, k3, line): findings as the lines of the report, with their sort key."""
    line = F.concat(F.lit("  ["), label_column(F.col("trace_id"), F.col("kind")), F.lit("] "), F.col("kind"), F.lit(" ("), F.col("severity"), F.lit("): "), F.col("detail"))
    return found.select("phase", "k1", "k2", "k3", line.alias("line"))


def write_report(entries: DataFrame, checkpoints: DataFrame, public: bytes, path: str, torn: str | None = None, most_ids: int = 10, most_bytes: int = 128) -> str:
    """The text of ``report`` as a folder of files that read in the order of their paths; its status.

    Findings are written by executors, range by range of their order, so there may be any number of them; the driver has
    the counts and a bounded number of other key ids.
    """
    spark = entries.sparkSession
    with work(spark):
        found = kept(findings(entries, checkpoints, public, torn))
        status = summary(found).first().status
        others = other_key_ids(entries, checkpoints, ed25519.key_id(public))
        ids = [r.key_id for r in others.orderBy("key_id").limit(most_ids).collect()]
        tail = Report(0, 0, [], ids).notes(others.count() if ids else 0, most_bytes)
        head = [COUNTS[0].format(entries.select("trace_id").distinct().count()), COUNTS[1].format(checkpoints.count()), status]
        for k, some in enumerate((head, None, tail)):
            # one file each but for the findings, which Spark deals by ranges
            lines = report_lines(found).orderBy("phase", "k1", "k2", "k3").select("line") if some is None else spark.createDataFrame([(x,) for x in some], "line string").coalesce(1)
            lines.write.mode("overwrite").text(f"{path.rstrip('/')}/part={k}")
    return status
