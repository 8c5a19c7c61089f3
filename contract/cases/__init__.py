"""All registered checks, by area."""

from importlib import import_module

AREAS = ("views", "blocks", "etl", "models")


def load() -> None:
    for area in AREAS:
        import_module(f"contract.cases.{area}")
