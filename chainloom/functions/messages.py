"""Log lines and error messages: parsing, classification, filters, SQL text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed: parts of messages after which an operation is tried again.
RETRYABLE = (
    "bad connection", "invalid connection", "broken pipe", "connection reset", "timeout", "deadlock", "commands out of sync", "connection refused", "connection closed",
    "Write conflict", "Information schema is changed", "Region is unavailable", "tikv is busy", "TiKV server timeout", "txn too large",
    "Error 1213", "Error 1205", "Error 2013", "Error 2006",
    "already been committed or rolled back", "context canceled", "context deadline exceeded",
)
# Fixed: parts, in lower case, of connection messages that need no action.
NON_CRITICAL = ("version mismatch", "handshake failed", "protocol negotiation")
# Fixed: parts of messages that are noise, whatever their source.
NOISE = (
    "Error 1062", "Duplicate entry", "duplicate key", "already processed", "Error 1568", "Transaction characteristics can't be changed", "Pool metadata fetch failed", "hash mismatch",
    "Historical sync detected", "Error 9007", "Write conflict", "Error 1213", "Deadlock found", "SLOW QUERY", "slow SQL",
)

_WARNED, _FAILED = ("Warning:", "[WARNING]"), ("Error:", "[ERROR]", "failed")
# Fixed: rules for log lines, the first that holds counts. A line must have one part of the first group and, where there
# is a second, one of that too; then kind, component and operation, or nothing for lines that are no errors.
LOG_RULES = (
    (("Error 1452", "foreign key constraint"), (), ("Constraint", "Database", "ForeignKey")),
    (("Error 1062", "Duplicate entry"), (), None),
    (("SLOW SQL", "slow query"), (), ("Slow Query", "Database", "SlowQuery")),
    (("failed to process",), (), ("Processing", "Processor", "ProcessBlock")),
    (_WARNED, ("failed to find existing transaction",), ("Warning", "Transaction", "Lookup")),
    (_WARNED, ("Historical reference",), ("Warning", "Transaction", "HistoricalRef")),
    (_WARNED, (), ("Warning", "General", "Warning")),
    (_FAILED, ("BlockFetch",), ("Processing", "BlockFetch", "Fetch")),
    (_FAILED, ("ChainSync",), ("Processing", "ChainSync", "Sync")),
    (_FAILED, ("connection",), ("Processing", "Network", "Connection")),
    (_FAILED, ("transaction",), ("Processing", "Transaction", "Process")),
    (_FAILED, ("block",), ("Processing", "Block", "Process")),
    (_FAILED, (), ("Processing", "General", "Error")),
    (("constraint",), (), ("Constraint", "Database", "Constraint")),
    (("deadlock",), (), ("Database", "Database", "Deadlock")),
    (("connection refused", "connection reset"), (), ("Network", "Network", "Connection")),
    (("timeout",), (), ("Network", "Network", "Timeout")),
)
# Fixed: kinds of a processor's errors by parts of their text; others are of kind Processing.
KIND_RULES = (
    (("foreign key", "duplicate", "constraint"), (), "Constraint"),
    (("connection", "timeout"), (), "Network"),
    (("validation",), (), "Validation"),
)
_PACKETS, _CONNECTION, _WAIT = ("packets.go",), ("connection.go",), ("timeout",)
# Fixed: rules for a database driver's lines in lower case: component, operation, kind and message; no message: the line.
DRIVER_RULES = (
    (_PACKETS, ("unexpected seq nr",), ("MySQL.Packets", "SequenceError", "Network", "Packet sequence number mismatch")),
    (_PACKETS, ("unexpected eof",), ("MySQL.Packets", "EOFError", "Network", "Unexpected EOF while reading packet")),
    (_PACKETS, ("packets out of order",), ("MySQL.Packets", "PacketOrder", "Network", "Packets received out of order")),
    (_PACKETS, (), ("MySQL.Packets", "Unknown", "Database", None)),
    (_CONNECTION, ("busy buffer",), ("MySQL.Connection", "BusyBuffer", "Network", "Connection buffer busy - possible protocol desync")),
    (_CONNECTION, ("bad connection",), ("MySQL.Connection", "BadConnection", "Network", "Connection in bad state")),
    (_CONNECTION, ("connection reset",), ("MySQL.Connection", "ConnectionReset", "Network", "Connection reset by peer")),
    (_CONNECTION, (), ("MySQL.Connection", "Unknown", "Database", None)),
    (("commands out of sync",), (), ("MySQL.Protocol", "CommandSync", "Database", "Commands out of sync - protocol error")),
    (("broken pipe",), (), ("MySQL.Network", "BrokenPipe", "Network", "Connection lost (broken pipe)")),
    (("connection refused",), (), ("MySQL.Network", "ConnectionRefused", "Network", "Connection refused by MySQL server")),
    (_WAIT, ("i/o timeout",), ("MySQL.Network", "Timeout", "Network", "Network I/O timeout")),
    (_WAIT, ("read timeout",), ("MySQL.Network", "Timeout", "Network", "Read timeout exceeded")),
    (_WAIT, ("write timeout",), ("MySQL.Network", "Timeout", "Network", "Write timeout exceeded")),
    (_WAIT, (), ("MySQL.Network", "Timeout", "Network", "Connection timeout")),
    (("too many connections",), (), ("MySQL.Connection", "ConnectionLimit", "Database", "Maximum connection limit reached")),
    (("deadlock",), (), ("MySQL.Transaction", "Deadlock", "Database", "Transaction deadlock detected")),
    (("",), (), ("MySQL", "Unknown", "Database", None)),
)

def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts))


def is_retryable(message: Column) -> Column:
    return F.coalesce(any_of(message, RETRYABLE), F.lit(False))


def is_non_critical(message: Column) -> Column:
    """No message at all is not critical either."""
    return F.coalesce(any_of(F.lower(message), NON_CRITICAL), F.lit(True))


def is_noise(kind: Column, component: Column, operation: Column, message: Column) -> Column:
    """Errors that normal operation brings about: known texts, and some texts only from some sources."""
    has = lambda part: F.contains(message, F.lit(part))
    compound = [
        (kind == "Constraint") & (operation == "DuplicateKey"),
        (kind == "Database") & has("connection reset by peer"),
        (kind == "Network") & (component == "MetadataFetcher"),
        (kind == "Processing") & has("metadata"),
        (component == "BlockProcessor") & (operation == "CollateralAddressLength") & has("Collateral address too long"),
    ]
    return reduce(lambda a, b: a | b, compound, any_of(message, NOISE))


def by_rules(text: Column, rules, value) -> Column:
    """``value(result)`` of the first rule whose groups the text meets; null if it meets none."""
    out = None
    for first, second, result in rules:
        holds = any_of(text, first) & any_of(text, second) if second else any_of(text, first)
        out = F.when(holds, value(result)) if out is None else out.when(holds, value(result))
    return out


def parse_log(line: Column) -> Column:
    """Struct of kind, component and operation of a log line; null if it is no error."""
    names = ("kind", "component", "operation")
    nothing = F.lit(None).cast("struct<kind:string,component:string,operation:string>")
    return by_rules(line, LOG_RULES, lambda r: F.struct(*[F.lit(x).alias(n) for n, x in zip(names, r, strict=True)]) if r else nothing)


def without_stamp(line: Column) -> Column:
    """What follows the first "] ", or the whole line."""
    at = F.instr(line, "] ")
    return F.when(at > 0, F.substring(line, at + 2, F.length(line))).otherwise(line)


def error_kind(message: Column) -> Column:
    """Kind of a processor's error by its text."""
    return F.coalesce(by_rules(message, KIND_RULES, F.lit), F.lit("Processing"))


def driver_error(line: Column) -> Column:
    """Struct of component, operation, kind and message of a database driver's line, with the numbers of lost packets."""
    names = ("component", "operation", "kind", "message")
    found = by_rules(F.lower(line), DRIVER_RULES, lambda r: F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(names, r, strict=True)]))
    got, want = (F.regexp_extract(line, r"got (\S+) want (\S+)", k) for k in (1, 2))
    numbers = F.when((found["operation"] == "SequenceError") & (got != ""), F.concat(F.lit("Packet sequence mismatch: got "), got, F.lit(" want "), want))
    return found.withField("message", F.coalesce(numbers, found["message"], clean(line)))


def clean(line: Column) -> Column:
    """The line without file:line words, clock times and the driver's prefix."""
    kept = F.filter(F.split(line, " "), lambda w: ~(F.contains(w, F.lit(".go:")) & w.rlike(r"\d")) & ~((F.length(w) > 8) & w.rlike(r"^..:..:")))
    return F.trim(F.regexp_replace(F.array_join(kept, " "), r"^(\[mysql\] |mysql: |\[MySQL\] )", ""))


def sql_operation(statement: Column) -> Column:
    word = F.upper(F.regexp_extract(F.trim(statement), r"^(\w+)", 1))
    return F.when(word.isin("SELECT", "INSERT", "UPDATE", "DELETE"), word).otherwise("QUERY")


def sql_table(statement: Column) -> Column:
    """Name after FROM, INTO, UPDATE or TABLE: the first of these words that occurs followed by a name and its end."""
    found = []
    for word in ("from", "into", "update", "table"):
        found += [F.regexp_extract(statement, rf"(?is){word} `(.*?)`", 1), F.regexp_extract(statement, rf"(?is){word} (.*?) ", 1)]
    return F.coalesce(*[F.when(f != "", f) for f in found], F.lit(""))


def shorten(statement: Column, most: int = 500) -> Column:
    return F.when(F.length(statement) > most, F.concat(F.substring(statement, 1, most), F.lit("..."))).otherwise(statement)
