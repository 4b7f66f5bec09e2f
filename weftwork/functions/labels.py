"""Label templates with ``${name}`` variables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.functions.identity import as_column


def label_names(template) -> Column:
    """The distinct variable names of a template."""
    names = F.regexp_extract_all(as_column(template), F.lit(r"\$\{(.+?)\}"), F.lit(1))
    return F.array_distinct(names)


def fill_label(template, values: Column) -> Column:
    """Replace each variable by its value in a map; a variable without a value stays as written."""
    template = as_column(template)

    def substitute(text: Column, name: Column) -> Column:
        variable = F.concat(F.lit("${"), name, F.lit("}"))
        return F.replace(text, variable, F.coalesce(F.try_element_at(values, name), variable))

    return F.aggregate(label_names(template), template, substitute)
