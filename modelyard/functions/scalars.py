"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two address forms and the endpoint suffix.
URI_PATTERN = r"^models:/([^/]+)(?:/([^/]+))?$"
URI_PREFIX = "models:/"
ENDPOINT_SUFFIX = "-serving-endpoint"


def binary_label(label: Column, positive: int) -> Column:
    """1 where the class equals `positive`, else 0; a NULL class stays NULL."""
    return (label == F.lit(positive)).cast("int")


def argmax_index(scores: Column) -> Column:
    """Zero-based index of the first largest score; NaN counts as largest; NULL for no scores."""
    position = F.array_position(scores, F.array_max(scores))
    return F.when(position > 0, position - 1).cast("bigint")


def endpoint_name(model_name: Column) -> Column:
    """Dots become dashes (literally), then the suffix."""
    return F.concat(F.replace(model_name, F.lit("."), F.lit("-")), F.lit(ENDPOINT_SUFFIX))


def model_uri(model_id: Column) -> Column:
    return F.concat(F.lit(URI_PREFIX), model_id)


def version_uri(name: Column, version: Column) -> Column:
    return F.concat(F.lit(URI_PREFIX), name, F.lit("/"), version.cast("string"))


def uri_subject(uri: Column) -> Column:
    """Model id or name; empty for a malformed address."""
    return F.regexp_extract(uri, URI_PATTERN, 1)


def uri_version(uri: Column) -> Column:
    """Second segment, empty when the address is the id form or malformed."""
    return F.regexp_extract(uri, URI_PATTERN, 2)


def qualified_name(catalog: Column, schema: Column, model: Column) -> Column:
    """Three-part name; missing parts become empty, they are not skipped."""
    parts = [F.coalesce(p.cast("string"), F.lit("")) for p in (catalog, schema, model)]
    return F.concat(parts[0], F.lit("."), parts[1], F.lit("."), parts[2])


def is_complete_name(name: Column) -> Column:
    """Exactly three non-empty parts."""
    return F.coalesce(name.rlike(r"^[^.]+\.[^.]+\.[^.]+$"), F.lit(False))


def stringify_values(params: Column) -> Column:
    """Map values as text, the form in which parameters are kept."""
    return F.transform_values(params, lambda _, value: value.cast("string"))


def parameter_number(params: Column, name: str) -> Column:
    """A parameter read back as a number; NULL when absent or not a number."""
    return F.element_at(params, name).try_cast("double")


def has_key_ignoring_case(tags: Column, name: str) -> Column:
    return F.coalesce(F.exists(F.map_keys(tags), lambda key: F.lower(key) == F.lit(name.lower())), F.lit(False))


def is_truthy_list(items: Column) -> Column:
    """Missing, NULL and empty lists are all false."""
    return F.coalesce(F.size(items), F.lit(0)) > 0


def dot_literals(features: Column, weights: list[float], intercept: float) -> Column:
    """Linear score of any width: the weights are array literals, so the expression stays flat.

    A row without features has no score.
    """
    used = [(i, float(w)) for i, w in enumerate(weights) if w != 0.0]
    score = F.lit(float(intercept))
    if used:
        places, values = zip(*used)
        terms = F.zip_with(
            F.lit(list(places)), F.lit(list(values)), lambda i, w: F.get(features, i).cast("double") * w
        )
        score = F.aggregate(terms, score, lambda acc, x: acc + x)
    return F.when(features.isNotNull(), score)


def dot_arrays(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )
