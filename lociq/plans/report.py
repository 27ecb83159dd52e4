"""A sortable HTML table of chimera rows."""

from __future__ import annotations

import html
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HEAD = """<!doctype html><meta charset="utf-8"><title>chimeras</title>
<style>td,th{padding:2px 6px;border:1px solid #ccc}th{cursor:pointer}</style>
<script>function by(k){const t=document.querySelector("tbody"),v=r=>r.cells[k].textContent;
[...t.rows].sort((a,b)=>isNaN(v(a))||isNaN(v(b))?v(a).localeCompare(v(b)):v(a)-v(b)).forEach(r=>t.append(r))}</script>
"""


def rows(chimeras: DataFrame, read_through: bool = False) -> DataFrame:
    return chimeras if read_through else chimeras.filter(F.col("chimera_type") != "Read_Through")


def lines(chimeras: DataFrame, *, read_through: bool = False, browser: str | None = None, cards: str | None = None) -> Iterator[str]:
    """The page, a row at a time; candidates that pass the filters are few. ``browser`` and ``cards`` are link patterns for places and genes."""
    shown = rows(chimeras, read_through).orderBy(F.desc("num_frags"), "chimera_id")
    yield _HEAD + "<table><thead><tr>" + "".join(f'<th onclick="by({i})">{c}</th>' for i, c in enumerate(shown.columns)) + "</tr></thead><tbody>\n"
    link = lambda pattern, text: f'<a href="{html.escape(pattern.format(text))}">{html.escape(text)}</a>' if pattern else html.escape(text)
    for r in shown.toLocalIterator():
        cells = []
        for c in shown.columns:
            v = r[c]
            if isinstance(v, list):
                cells.append(", ".join(link(cards if c.startswith("genes") else None, str(x)) for x in v))
            elif c in ("rname5p", "rname3p") and browser:
                side = c[-2:]
                cells.append(link(browser, f"{v}:{r[f'start{side}']}-{r[f'end{side}']}"))
            else:
                cells.append(html.escape(str(v)))
        yield "<tr>" + "".join(f"<td>{x}</td>" for x in cells) + "</tr>\n"
    yield "</tbody></table>\n"
