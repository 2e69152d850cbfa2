"""Settings of a module: defaults with a module's own over them."""

from __future__ import annotations

from pathlib import Path

#: Settings that hold where a module says nothing.
DEFAULTS = {"ignored_tiers": [], "extracted_tiers": [], "translation_suffix": "_trad", "variation_markers": [], "nvb_participates": False, "duration_threshold": 0.1, "normalization": {}, "reduction_words": ["cioè"]}


def merged(base: dict, over: dict) -> dict:
    """Dictionaries are merged key by key, everything else is replaced whole."""
    out = dict(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load(path: str | Path | None = None, defaults: dict | None = None) -> dict:
    """Settings from a YAML file over the defaults; without a path the defaults. A file that isn't there is an error."""
    base = DEFAULTS if defaults is None else defaults
    if path is None:
        return merged(base, {})
    import yaml

    return merged(base, yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})


def ignored(path: str | Path | None) -> list[list[int]]:
    """The groups of unit ids of an annotation file's `ignore` list."""
    if path is None or not Path(path).exists():
        return []
    import yaml

    return [[int(x) for x in line.split()] for line in (yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}).get("ignore", [])]
