"""Reports from small result frames: warnings with stable codes, Markdown blocks, charts and injection between markers."""

from __future__ import annotations

import html
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The warning codes.
CODES = (
    "tiny_mode", "no_eval_set", "no_run_found", "teacher_skipped", "no_student", "paired_failed", "no_calibration",
    "gate_not_usable", "gate_degenerate", "cascade_unverified", "quantized_unevaluated", "quantization_missing",
    "no_teacher_run", "no_teacher_config", "no_pricing", "no_prompt_tokens", "no_throughput", "cost_unbatched",
    "replay_teacher", "dirty_tree", "eval_mode_mismatch", "corpus_teacher_differs",
)
BEGIN, END = "<!-- results:begin -->", "<!-- results:end -->"


@dataclass
class Report:
    """Tables by title, and warnings; missing data is a warning, never an error."""

    tables: dict[str, list[dict]] = field(default_factory=dict)
    warnings: list[tuple[str, str]] = field(default_factory=list)

    def warn(self, code: str, text: str) -> None:
        if code not in CODES:
            raise ValueError(f"unknown warning code {code}")
        self.warnings.append((code, text))

    def add(self, title: str, df: DataFrame | None, code: str, most: int = 1000) -> None:
        """At most ``most`` rows of a result; a warning if there are none."""
        rows = [r.asDict() for r in df.limit(most).collect()] if df is not None else []
        if rows:
            self.tables[title] = rows
        else:
            self.warn(code, f"{title}: no rows")


def cell(x) -> str:
    if x is None:
        return "n/a"
    return f"{x:.4g}" if isinstance(x, float) else str(x).replace("|", "\\|").replace("\n", " ")


def markdown(report: Report) -> str:
    lines = [BEGIN]
    for title, rows in report.tables.items():
        names = list(rows[0])
        lines += [f"### {title}", "", "| " + " | ".join(names) + " |", "|" + "-|" * len(names), *("| " + " | ".join(cell(r[n]) for n in names) + " |" for r in rows), ""]
    if report.warnings:
        lines += ["**Warnings:**", "", *(f"- `{c}`: {t}" for c, t in report.warnings), ""]
    return "\n".join([*lines, END])


def page(report: Report) -> str:
    """A plain HTML page."""
    body = []
    for title, rows in report.tables.items():
        names = list(rows[0])
        head = "".join(f"<th>{html.escape(n)}</th>" for n in names)
        body.append(f"<h2>{html.escape(title)}</h2><table><tr>{head}</tr>" + "".join("<tr>" + "".join(f"<td>{html.escape(cell(r[n]))}</td>" for n in names) + "</tr>" for r in rows) + "</table>")
    body += [f"<p class=warning>{html.escape(c)}: {html.escape(t)}</p>" for c, t in report.warnings]
    return "<!doctype html><meta charset=utf-8>" + "".join(body)


def inject(text: str, block: str) -> str:
    """``block`` between its markers in ``text``, or in a new section at the end; a second time changes nothing."""
    before, begin, rest = text.partition(BEGIN)
    _, end, after = rest.partition(END)
    return before + block + after if begin and end else f"{text.rstrip()}\n\n## Results\n\n{block}\n"


def chart(points: list[tuple[float, float]], width: int = 320, height: int = 200) -> str:
    """An SVG line through points scaled to the box."""
    if not points:
        return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"/>'
    xs, ys = zip(*points, strict=True)
    scale = lambda v, lo, hi, size: 10 + (size - 20) * ((v - lo) / (hi - lo) if hi > lo else 0.5)
    line = " ".join(f"{scale(x, min(xs), max(xs), width):.1f},{height - scale(y, min(ys), max(ys), height):.1f}" for x, y in points)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><polyline fill="none" stroke="black" points="{line}"/></svg>'


def assert_report(report: Report, required: list[str], forbidden: list[str] = (), allowed: list[str] | None = None) -> list[str]:
    """What is wrong with a report: missing tables, forbidden codes, codes that aren't allowed."""
    codes = [c for c, _ in report.warnings]
    wrong = [f"missing: {t}" for t in required if t not in report.tables] + [f"forbidden: {c}" for c in codes if c in forbidden]
    return wrong + ([f"not allowed: {c}" for c in codes if c not in allowed] if allowed is not None else [])


def curation_report(funnel: DataFrame, reasons: DataFrame, coverage: DataFrame) -> Report:
    r = Report()
    r.add("Stages", funnel, "no_run_found")
    r.add("Reasons", reasons.orderBy(F.desc("n")), "no_run_found")
    r.add("Coverage", coverage, "no_run_found")
    return r
