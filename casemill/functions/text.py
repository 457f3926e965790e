"""Small text and label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casemill.functions.uniform import as_column


def parent_code(code: Column | str, length: int = 3) -> Column:
    return F.substring(as_column(code), 1, length)


def first_letter_upper(name: Column | str) -> Column:
    """Upper-case the first letter of the whole string, lower-case everything after it."""
    name = as_column(name)
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))))


def display(label: Column | str, code: Column | str) -> Column:
    """``label (code)``, or the code alone where no label is known."""
    label, code = as_column(label), as_column(code)
    return F.when(F.coalesce(label, F.lit("")) != "", F.concat(label, F.lit(" ("), code, F.lit(")"))).otherwise(code)


def sex_label(sexe: Column | str) -> Column:
    """Exactly 1 is male, anything else that is not null is female."""
    sexe = as_column(sexe)
    return F.when(sexe == 1, F.lit("Masculin")).when(sexe.isNotNull(), F.lit("Féminin"))


def line(prefix: str, value: Column, suffix: str = "\n") -> Column:
    """One text line; null where the value is null, so that ``concat_ws`` leaves the line out."""
    return F.concat(F.lit(prefix), value.cast("string"), F.lit(suffix))


def row_key(*values: Column | str) -> Column:
    """Several values as one text that tells any two rows apart: null is ``~``, anything else follows a ``=`` with the
    separator doubled. Lists are written the same way, with commas."""

    def marked(text: Column, separator: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.replace(text, F.lit(separator), F.lit(2 * separator))), F.lit("~"))

    return F.concat_ws("|", *[marked(F.col(v).cast("string") if isinstance(v, str) else v, "|") for v in values])


def list_text(values: Column | str) -> Column:
    """A list of texts as one text; null for a null list."""
    item = lambda x: F.coalesce(F.concat(F.lit("="), F.replace(x, F.lit(","), F.lit(",,"))), F.lit("~"))
    return F.array_join(F.transform(values, item), ",")
