"""What a load run can be told."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from cohortloom.functions.keys import ID_SPACE


def _number(text: str | None, default: int) -> int:
    try:
        return int(text) if text is not None else default
    except ValueError:
        return default


@dataclass(frozen=True)
class Settings:
    """``secret`` keys the pseudonyms, the windows are days.

    ``id_columns`` replaces the source columns an event table's id is hashed from, e.g.
    ``{"condition_occurrence": ["patient", "code", "start"]}`` for one id per row instead of
    one per patient. ``id_space`` is the number of distinct surrogate ids. ``coerce_first``
    types code columns as numbers before they are looked up, so that only numeric codes
    resolve. ``rebuild_eras`` recomputes the era tables instead of appending the new eras.
    """

    secret: str
    condition_window: int = 30
    drug_window: int = 30
    dose_window: int = 30
    visit_gap: int = 1
    id_columns: Mapping[str, list[str]] = field(default_factory=dict)
    id_space: int = ID_SPACE
    coerce_first: bool = False
    rebuild_eras: bool = False
    date_formats: tuple[str, ...] = ()

    @staticmethod
    def from_environment(**overrides) -> Settings:
        """Secret and windows from ENCRYPT_KEY, CONDITION_WINDOW, DRUG_WINDOW, DOSE_WINDOW."""
        values = {
            "secret": os.environ.get("ENCRYPT_KEY"),
            "condition_window": _number(os.environ.get("CONDITION_WINDOW"), 30),
            "drug_window": _number(os.environ.get("DRUG_WINDOW"), 30),
            "dose_window": _number(os.environ.get("DOSE_WINDOW"), 30),
            **overrides,
        }
        if not values["secret"]:
            raise ValueError("set ENCRYPT_KEY or pass secret")
        return Settings(**values)
