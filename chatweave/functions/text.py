"""String expressions for inputs, commands and short displays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a full Unicode strip removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The chat commands.
EXIT_COMMANDS = ("/exit", "/quit")
PLAIN_EXIT_WORDS = ("quit", "exit", "q")
CLEAR_COMMAND = "/clear"
SYSTEM_PREFIX = "/system "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove every Unicode blank from both ends (a plain ``trim`` removes spaces only)."""
    return F.btrim(_col(c), F.lit(BLANKS))


def is_blank(c: Column | str) -> Column:
    return strip(c) == ""


def classify_command(stripped: Column | str) -> Column:
    """``exit``, ``clear``, ``system`` or ``turn`` for a stripped input."""
    low = F.lower(_col(stripped))
    return (
        F.when(low.isin(*EXIT_COMMANDS), "exit")
        .when(low == CLEAR_COMMAND, "clear")
        .when(low.startswith(SYSTEM_PREFIX), "system")
        .otherwise("turn")
    )


def command_argument(stripped: Column | str) -> Column:
    """The text after the system prefix, case kept."""
    return strip(F.substr(_col(stripped), F.lit(len(SYSTEM_PREFIX) + 1)))


def is_plain_exit(stripped: Column | str) -> Column:
    """The exit rule of the plain prompt loop, which has no other commands."""
    return F.lower(_col(stripped)).isin(*PLAIN_EXIT_WORDS)


def preview(c: Column | str, n: int = 50) -> Column:
    """The first ``n`` characters; the ellipsis is always added."""
    return F.concat(F.substring(_col(c), 1, n), F.lit("..."))


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)


def join_list(c: Column | str) -> Column:
    """Comma-joined list; a missing list gives an empty string."""
    return F.array_join(F.coalesce(_col(c), F.array().cast("array<string>")), ", ")


def mebibytes(n: Column | str) -> Column:
    return _col(n).cast("double") / F.lit(1024.0 * 1024.0)


def gibibytes(n: Column | str) -> Column:
    return _col(n).cast("double") / F.lit(1024.0 * 1024.0 * 1024.0)


def one_decimal(c: Column | str) -> Column:
    """Exact ties go to the even digit."""
    return F.format_string("%.1f", F.bround(_col(c), 1))


def two_decimals(c: Column | str) -> Column:
    """Exact ties go to the even digit."""
    return F.format_string("%.2f", F.bround(_col(c), 2))


def thousands(c: Column | str) -> Column:
    return F.format_number(_col(c), 0)
