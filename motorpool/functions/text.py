"""Text normalisation."""

from pyspark.sql import functions as F

# The characters of the Unicode White_Space property.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680\u2000"
    "\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(col):
    """Lower-case without surrounding white space of any kind.

    Spark's one-argument ``trim`` strips the space character only.
    """
    return F.btrim(F.lower(col), F.lit(WHITESPACE))


def join_non_null(separator, *cols):
    """Concatenate with a separator; NULL as soon as one part is NULL."""
    parts = []
    for col in cols:
        parts += [F.lit(separator), col]
    return F.concat(*parts[1:])
