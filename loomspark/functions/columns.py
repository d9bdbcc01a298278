"""Column expressions of the dump's scalar rules; all stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mw_timestamp(c: Column | str) -> Column:
    """14 digits to a UTC instant; null for blanks, ``infinity``, year 0000 and dates that do not exist."""
    s = F.trim(_col(c))
    return F.when(s.rlike("^[0-9]{14}$") & ~s.startswith("0000"), F.try_to_timestamp(s, F.lit("yyyyMMddHHmmss")))


def iso_timestamp(c: Column | str) -> Column:
    """ISO 8601 with ``Z`` or an offset; anything else is null."""
    return F.trim(_col(c)).try_cast("timestamp")


def unix_timestamp(c: Column | str) -> Column:
    """Seconds since 1970, null if not a number."""
    return F.timestamp_seconds(_col(c).try_cast("bigint"))


def latin1_bytes(c: Column | str) -> Column:
    """One byte for each code point up to 255."""
    return F.encode(_col(c), "ISO-8859-1")


def latin1_text(c: Column | str) -> Column:
    return F.decode(_col(c), "ISO-8859-1")


def utf8_text(c: Column | str) -> Column:
    """Bytes as UTF-8, or as latin-1 where they are not valid UTF-8."""
    b = _col(c)
    return F.when(F.is_valid_utf8(b.cast("string")), b.cast("string")).otherwise(F.decode(b, "ISO-8859-1"))


def strict_int(c: Column | str) -> Column:
    """Whole number; blank is null and junk fails the query (ANSI cast)."""
    return F.nullif(F.trim(_col(c)), F.lit("")).cast("bigint")


def lenient_int(c: Column | str) -> Column:
    """Whole number; blank and junk are null."""
    return F.nullif(F.trim(_col(c)), F.lit("")).try_cast("bigint")


def strict_double(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit("")).cast("double")


def truth(kind: Column | str, value: Column | str) -> Column:
    """A dump literal as boolean: numbers by not being zero; strings false for '', 0, false, False;
    bytes false for b'', b'0' and a NUL.  A NUL in a plain string counts as true."""
    k, v = _col(kind), _col(value)
    return (
        F.when(v.isNull(), F.lit(None).cast("boolean"))
        .when(k == "int", v.try_cast("bigint") != 0)
        .when(k == "float", v.try_cast("double") != 0)
        .when(k == "bytes", ~v.isin("", "0", "\0"))
        .otherwise(~v.isin("", "0", "false", "False"))
    )


def split_title(title: Column | str, spaces: Column) -> tuple[Column, Column]:
    """Namespace number and rest of a title, split at its first colon.

    ``spaces`` maps lower-cased prefixes to numbers.  A prefix it lacks leaves the title
    whole in namespace 0; a missing title is empty there.
    """
    t = F.coalesce(_col(title), F.lit(""))
    at = F.instr(t, ":")
    number = F.when(at > 0, F.try_element_at(spaces, F.lower(F.substring_index(t, ":", 1))))
    rest = F.when(number.isNotNull(), F.substring(t, at + 1, F.length(t))).otherwise(t)
    return F.coalesce(number, F.lit(0)).cast("int"), rest


def default_action(action: Column | str, kind: Column | str) -> Column:
    """The action, or the type where it is null or empty."""
    return F.coalesce(F.nullif(_col(action), F.lit("")), _col(kind))


def deleted_bits(comment: Column, user: Column) -> Column:
    """2 for a suppressed comment, 4 for a suppressed user."""
    return (F.when(comment, 2).otherwise(0).bitwiseOR(F.when(user, 4).otherwise(0))).cast("int")


def text_length(c: Column | str) -> Column:
    """Bytes of the UTF-8 text; a missing text has none."""
    return F.octet_length(F.coalesce(_col(c), F.lit("")))


def text_binary(c: Column | str) -> Column:
    return F.encode(F.coalesce(_col(c), F.lit("")), "UTF-8")


def is_talk(namespace: Column | str) -> Column:
    """Talk namespaces are odd; virtual ones (negative) are neither stored nor talk."""
    n = _col(namespace)
    return (n >= 0) & (n % 2 == 1)


def subject_namespace(namespace: Column | str) -> Column:
    n = _col(namespace)
    return (n - F.pmod(n, F.lit(2))).cast("int")


def part_number(name: Column | str) -> Column:
    """The part number in a dump file's name, for natural order; 0 if it has none."""
    return F.coalesce(F.nullif(F.regexp_extract(_col(name), r"(?:history|stub)(\d+)\.", 1), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def page_start(name: Column | str) -> Column:
    """The first page number in a dump file's name; 0 if it has none."""
    return F.coalesce(F.nullif(F.regexp_extract(_col(name), r"p(\d+)p\d+", 1), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def file_kind(name: Column | str) -> Column:
    """Where a file belongs, by its suffix."""
    n = _col(name)
    return (
        F.when(n.endswith(".sql.gz"), "sql")
        .when(n.endswith(".7z"), "history")
        .when(n.contains("stub") & n.endswith(".xml.gz"), "stub")
        .when(n.endswith(".xml.gz") | n.endswith(".xml"), "xml")
        .when(n.endswith("sums.txt"), "checksums")
        .otherwise("other")
    )


def signature_user(line: Column | str) -> Column:
    """First linked user of a line, '' if none."""
    return F.regexp_extract(_col(line), r"\[\[User:(.+?)\|", 1)


def signature_date(line: Column | str) -> Column:
    return F.regexp_extract(_col(line), r"(\d{2}:\d{2}, \d{1,2} \w+ \d{4}) \(UTC\)", 1)


def section_name(line: Column | str) -> Column:
    return F.regexp_extract(_col(line), r"^==\s*(.+?)\s*==", 1)


def indentation(line: Column | str) -> Column:
    """Colons that a line begins with."""
    s = _col(line)
    return F.length(s) - F.length(F.ltrim(s, F.lit(":")))


def escaped_bytes(c: Column | str) -> Column:
    """Binary as printable text: backslashes doubled, NUL and bytes from 128 as three octal digits.

    The bytes pass as latin-1 so that one character is one byte; every character that
    needs it is replaced by its own escape, on the JVM.
    """
    text = F.replace(F.decode(_col(c), "ISO-8859-1"), F.lit("\\"), F.lit("\\\\"))
    pieces = F.transform(F.split(text, ""), _escape)
    return F.when(F.exists(F.split(text, ""), lambda x: (F.ascii(x) >= 128) | (x == "\0")), F.array_join(pieces, "")).otherwise(text)


def _escape(x: Column) -> Column:
    code = F.ascii(x)
    return F.when((code >= 128) | (x == "\0"), F.concat(F.lit("\\"), F.lpad(F.conv(code.cast("string"), 10, 8), 3, "0"))).otherwise(x)
