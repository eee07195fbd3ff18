"""Reserved label keys and label text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Characters that search syntax reserves, and their substitute.
ILLEGAL_LABEL_CHARS = r"[:?*]"
LABEL_SUBSTITUTE = "_"


@dataclass(frozen=True)
class Naming:
    """Spellings derived from the name of the launcher that wrote the archive.

    Label keys, scheduler job names, source directives and meta keys all carry that
    name, so one parameter sets them all.
    """

    tool: str = "run"

    @property
    def str_label(self) -> str:
        return f"{self.tool}-str-label"

    @property
    def user(self) -> str:
        return f"{self.tool}-user"

    @property
    def backend(self) -> str:
        return f"{self.tool}-backend"

    @property
    def job_prefix(self) -> str:
        return f"{self.tool.upper()}_"

    def directive(self, kind: str) -> str:
        """Comment line ``# TOOL docker "image"`` in a source file."""
        return rf"^\s*\#\s*{self.tool.upper()}\s+{kind}\s(.+)"

    def image_keys(self, kind: str) -> list[str]:
        """Meta keys of the default environment, in order of preference."""
        stems = [f"default_{kind}", f"{self.tool}_{kind}"]
        if kind == "conda":
            return [key for stem in stems for key in (stem, f"{stem}_env")]
        return stems


DEFAULT_NAMING = Naming()


def clean_label(s: Column) -> Column:
    return F.regexp_replace(s, ILLEGAL_LABEL_CHARS, LABEL_SUBSTITUTE)


def label_changed(s: Column) -> Column:
    return s.rlike(ILLEGAL_LABEL_CHARS)
