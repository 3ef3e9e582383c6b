"""Numbers that are part of the operators' meaning. Pass another instance to change them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # Fixed values.
    min_pdf_bytes: int = 1024
    min_visible_chars: int = 80
    min_printable_ratio: float = 0.85
    max_replacement_ratio: float = 0.02
    noise_min_pages: int = 3
    noise_page_percent: int = 30
    noise_edge_lines: int = 3
    noise_max_chars: int = 120
    heading_max_chars: int = 120
    heading_max_words: int = 14
    complex_table: float = 0.60
    poor_table: float = 0.70
    wide_block: float = 0.70
    figure_image_ratio: float = 0.05
    figure_drawings: int = 20
    scanned_image_ratio: float = 0.50


DEFAULT = Thresholds()
