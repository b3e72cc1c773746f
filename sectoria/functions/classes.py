"""Fixed classes and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Left-closed age classes; ages of 130 and more have none.
AGE_CLASSES_4 = [(0, 30, "0-30"), (30, 60, "30-60"), (60, 90, "60-90"), (90, 130, "90+")]
AGE_CLASSES_7 = [
    (0, 1, "0-1"),
    (1, 20, "1-20"),
    (20, 35, "20-35"),
    (35, 50, "35-50"),
    (50, 65, "50-65"),
    (65, 90, "65-90"),
    (90, 130, "90+"),
]

# Mobility labels from the closest birth place to the farthest.
MOBILITY_LABELS = ["Urbaine", "Départementale", "Régionale", "Nationale", "Internationale"]


def age_class(age: Column, classes: Sequence[tuple[int, int, str]] = AGE_CLASSES_7) -> Column:
    label = F.lit(None).cast("string")
    for low, high, name in reversed(classes):
        label = F.when((age >= low) & (age < high), name).otherwise(label)
    return label


def class_rank(label: Column, classes: Sequence[tuple[int, int, str]] = AGE_CLASSES_7) -> Column:
    """Position of a class label in its order, from 1; 0 for an unknown label."""
    return F.array_position(F.array(*[F.lit(c[2]) for c in classes]), label).cast("int")


def label_of(code: Column, labels: Mapping[str, str], default: Column | None = None) -> Column:
    """Label of a code by a small fixed map; ``default`` (null) for other codes."""
    result = default if default is not None else F.lit(None).cast("string")
    for key, label in labels.items():
        result = F.when(code == key, label).otherwise(result)
    return result


def harmonise(category: Column, synonyms: Mapping[str, str]) -> Column:
    """Replace known spellings, keep everything else."""
    return label_of(category, synonyms, default=category)


def national_flag(country: Column, home: str = "FRANCE") -> Column:
    return F.when(country == home, "O").otherwise("N")


def mobility_class(city: Column, department: Column, region: Column, nation: Column) -> Column:
    """Mobility label from the native flags of the four levels, closest level first.

    A wider level counts only when every closer flag is ``N``, so a null flag
    on the way leads to the last label.
    """
    flags = [city, department, region, nation]
    label = F.lit(MOBILITY_LABELS[-1])
    for level in reversed(range(4)):
        condition = flags[level] == "O"
        for closer in flags[:level]:
            condition = condition & (closer == "N")
        label = F.when(condition, MOBILITY_LABELS[level]).otherwise(label)
    return label
