"""What the state of a stateful query was laid out for, kept beside its checkpoint.

A query started with other settings than its record is refused: its state would not fit, or its log
would mix results of two kinds. ``rebuild_enriched`` and ``rebuild_counts`` start a new generation
with other settings; ``hand_over`` starts one from batch results. A generation has a checkpoint and
a log folder of its own, as a log folder follows one checkpoint.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyarrow import fs

from orderloom.functions.stores import store_of


class LayoutChanged(ValueError):
    """The settings differ from those that the state was laid out for."""


@dataclass(frozen=True)
class Layout:
    """``settings`` must stay the same; ``spreads`` lists hot keys with their groups, if measured.

    A generation after the first may begin from ``state`` (a folder of rows), leaving out the files
    listed in ``seen`` (a folder by source) and rows at or before ``after`` (microseconds).
    """

    settings: dict
    generation: int = 0
    spreads: dict[str, int] = field(default_factory=dict)
    state: str | None = None
    seen: str | None = None
    after: int | None = None

    def name(self, query: str) -> str:
        return query if not self.generation else f"{query}@{self.generation}"


def _path(base: str, query: str) -> str:
    return f"{base}/_layouts/{query}.json"


def read(base: str, query: str) -> Layout | None:
    store, inner = store_of(_path(base, query))
    if store.get_file_info(inner).type != fs.FileType.File:
        return None
    with store.open_input_stream(inner) as body:
        return Layout(**json.loads(body.read()))


def write(base: str, query: str, layout: Layout) -> Layout:
    """Put a record in place of the one before, whole or not at all."""
    store, inner = store_of(_path(base, query))
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    aside = f"{inner}.{uuid.uuid4().hex}"
    with store.open_output_stream(aside, compression=None) as out:
        out.write(json.dumps(asdict(layout)).encode())
    store.move(aside, inner)
    return layout


def check(query: str, layout: Layout, settings: dict) -> Layout:
    """The layout if it fits the settings; a setting of None asks for nothing."""
    other = {k: v for k, v in settings.items() if v is not None and layout.settings.get(k) != v}
    if other:
        raise LayoutChanged(
            f"{query} was laid out for {layout.settings} and cannot go on with {other}; rebuild it, or use its settings"
        )
    return layout


def next_of(layout: Layout, **changed) -> Layout:
    return replace(layout, generation=layout.generation + 1, **changed)
