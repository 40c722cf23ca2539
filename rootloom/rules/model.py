"""Shapes of rule packs.  Operators read these; packs only hold values."""

from __future__ import annotations

from dataclasses import dataclass, field


def java_regex(pattern: str) -> str:
    """Unicode word rules of the packs (``\\w``, ``\\b``) in Java's regex dialect.

    Java's own ``\\w`` either ignores non-Latin letters or swallows combining
    marks, so both are spelled out; ``(?U)`` widens ``\\s`` and ``\\d`` only,
    ``(?d)`` keeps ``\\n`` as the single line terminator.
    """
    word = r"[\p{L}\p{N}_]"
    edge = rf"(?:(?<!{word})(?={word})|(?<={word})(?!{word}))"
    return "(?Ud)" + pattern.replace(r"\w", word).replace(r"\b", edge)


@dataclass(frozen=True)
class Profile:
    """Character folding: ``delete`` characters, map ``fold_from`` to ``fold_to``."""

    delete: str = ""
    fold_from: str = ""
    fold_to: str = ""
    lower: bool = False
    strip_prefix: str | None = None
    collapse: bool = True


@dataclass(frozen=True)
class OriginRule:
    """One step of the first-match cascade that types an entry."""

    name: str
    pattern: str
    entry_type: str
    axes_count: int | None
    groups: tuple[int, ...] = ()
    first_only: bool = False
    window: int | None = None
    extract: str | None = None
    extract_window: int | None = None


@dataclass(frozen=True)
class OriginPack:
    name: str
    profile: Profile
    chains: tuple[str, ...]
    context_prefixes: tuple[str, ...]
    rules: tuple[OriginRule, ...]
    authorities: str
    ocr_suspect: str
    noise: str | None = None
    pre_strip: Profile | None = None
    raw_prefix: str | None = None


@dataclass(frozen=True)
class LinePack:
    """Patterns that type the lines of a book page."""

    chapter: str
    bracket: str
    confirm: str
    strict: str
    geminate: str
    footnote: str
    poetry: str
    page_ref: str
    page_ref_groups: int
    letter_names: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Marker:
    name: str
    segment_type: str
    pattern: str


@dataclass(frozen=True)
class ClaimRule:
    """Pattern giving a claim of ``claim_type`` inside one segment type."""

    segment_type: str
    claim_type: str
    pattern: str
    term_group: int = 0
    definition_group: int = 0
    authority: str | int | None = None
    definition_limit: int | None = None
    requires: str | None = None


@dataclass(frozen=True)
class DiscoursePack:
    """Everything the body, claim and sense jobs need for one language."""

    markers: tuple[Marker, ...]
    split_order: tuple[str, ...]
    ocr_fix: tuple[str, str]
    claim_rules: tuple[ClaimRule, ...]
    authority_trail: str
    anonymous: str
    self_markers: tuple[str, ...]
    hedge: str
    usage_cues: tuple[tuple[str, str], ...]
    poetry_cue: str
    xref_phrase: str
    strength_cues: tuple[tuple[str, str], ...]
    confusions: tuple[tuple[str, str], ...]
    script_class: str
    boundary_probe: str
    boundary_split: str
    nucleus_rules: tuple[str, ...]
    first_words: str
    semantic_kinds: tuple[tuple[str, str], ...]
    abstraction: tuple[tuple[str, str], ...]
    temporal: tuple[tuple[str, str], ...]
    relations: tuple[tuple[str, str], ...]
    distances: tuple[tuple[str, str], ...]
    domains: tuple[tuple[str, str], ...]
    xref_target: str
    event_kinds: tuple[tuple[str, str], ...]
    oppositions: tuple[tuple[str, str], ...]
    term_profile: Profile = Profile()
    origin_profile: Profile = Profile()
    entity_profile: Profile = Profile()
