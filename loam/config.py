"""Settings of the curation stages. Nothing is read at import; load() takes a YAML file with these names."""

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Gates:
    min_size: int = 1024
    min_sharpness: float = 100.0
    drop_small: bool = True
    drop_blurry: bool = True
    max_hamming: int = 8
    text_share: float = 0.10
    tiles: int = 4
    tile_sharpness: float = 100.0
    tile_share: float = 0.5


@dataclass(frozen=True)
class Captions:
    #: Hard block; it can be extended, and no setting turns it off.
    blocked: tuple[str, ...] = ("loli", "shota", "toddlercon", "child", "baby", "infant", "toddler", "aged_down")
    label_map: dict[str, str] = field(default_factory=lambda: {"NORMAL": "rating:general", "NSFW": "rating:explicit"})
    default_rating: str = "rating:general"
    retries: int = 4
    concurrency: int = 12


@dataclass(frozen=True)
class Ratios:
    target: dict[str, float] = field(default_factory=lambda: {"detail": 0.60, "anchor": 0.35, "bg": 0.05})
    tolerance: float = 0.10


@dataclass(frozen=True)
class Fetch:
    """Options of a fetch, whatever the source."""

    keys: tuple[str, ...] = ()
    most_saved: int = 1000
    most_reads: int = 1000
    least_side: int = 1536
    labels: tuple[str, ...] = ()
    most_samples: int = 1000
    out: str = "data/raw"


@dataclass(frozen=True)
class Settings:
    gates: Gates = field(default_factory=Gates)
    captions: Captions = field(default_factory=Captions)
    ratios: Ratios = field(default_factory=Ratios)
    fetch: Fetch = field(default_factory=Fetch)


def load(path: str) -> Settings:
    """Unknown names are an error; what is missing keeps its default."""
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    parts = {}
    for part in fields(Settings):
        kind = part.default_factory
        given = {k: tuple(v) if isinstance(v, list) else v for k, v in (raw.get(part.name) or {}).items()}
        if part.name == "captions" and "blocked" in given:
            given["blocked"] = tuple(dict.fromkeys((*Captions.blocked, *given["blocked"])))
        parts[part.name] = kind(**given)
    return Settings(**parts)
