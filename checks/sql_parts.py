"""SQL pieces for the twins, built from the fixed values the library uses as well."""

from __future__ import annotations


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values: list[str]) -> str:
    return "[" + ", ".join(map(text, values)) + "]"


def one_of(value: str, codes: list[int]) -> str:
    return f"list_contains({list(codes)}, {value})"


def holds_any(value: str, marks: list[str]) -> str:
    """Whether a text holds one of the marks."""
    return f"len(list_filter({texts(marks)}, lambda mark: contains({value}, mark))) > 0"


def band(value: str, table: list[tuple], inclusive: bool = False) -> str:
    """Label of the band a value falls in: the number of limits it has passed picks the label; null is in the first."""
    limits = [limit for limit, _ in table if limit is not None]
    passed = f"len(list_filter({limits}, lambda edge: {value} {'>' if inclusive else '>='} edge))"
    return f"({texts([label for _, label in table])})[1 + {passed}]"


def real_shop(code: str, marks: list[str]) -> str:
    return f"NOT {holds_any(code, marks)}"
