"""Parameters of the session filter and of the page flow."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


def parse_list(text: str | None) -> tuple[str, ...]:
    """Split a parameter such as ``"1, 2, 3"``; empty text gives an empty tuple."""
    return tuple(part.strip() for part in (text or "").split(",") if part.strip())


@dataclass(frozen=True)
class SessionFilter:
    """Conditions a session must meet; an empty condition is off.

    Lists are comma-separated text. ``keywords`` and ``category_ids`` pass a session
    that searched for, or clicked, at least one of the listed values.
    """

    # Default age range and page flow.
    start_age: int = 30
    end_age: int = 50
    professionals: str = ""
    cities: str = ""
    sex: str = ""
    keywords: str = ""
    category_ids: str = ""
    target_page_flow: str = "1, 2, 3, 4, 5, 6, 7"

    @classmethod
    def from_params(cls, params: Mapping[str, object]) -> SessionFilter:
        return cls(**params)

    @property
    def page_flow(self) -> list[int]:
        return [int(page) for page in parse_list(self.target_page_flow)]
