"""Portal selection of the load (the load itself is ``plans/store.py``).

Portal selection (S3) is resolved on the parameters, then applied as an
``isin`` on the ``portal`` partition column, so unselected portals are pruned
at the file level.
"""

from __future__ import annotations

from typing import Sequence

from ..constants import PORTAL_KEYS, PORTAL_LABELS


def _term_hits(term: str, label: str) -> bool:
    t = term.lower().replace("_", "-")
    name = label.lower()
    return t in name or (t in ("no", "nieruchomosci-online") and "nieruchomości" in name)


def select_portals(include: Sequence[str] | None = None,
                   exclude: Sequence[str] | None = None) -> list[str]:
    """S3: portal keys selected by include / exclude terms matched against
    the display names (case-folded, '_' as '-', alias 'no')."""
    chosen = list(zip(PORTAL_KEYS, PORTAL_LABELS))
    if include:
        chosen = [(k, n) for k, n in chosen if any(_term_hits(t, n) for t in include)]
    if exclude:
        chosen = [(k, n) for k, n in chosen if not any(_term_hits(t, n) for t in exclude)]
    return [k for k, _ in chosen]
