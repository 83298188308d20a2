"""Mixture description and the fixed values of the corpus format."""

from __future__ import annotations

import json
from dataclasses import dataclass, field as dc_field
from pathlib import Path

# Fixed values of the format: they decide token ids and file contents.
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", "<pad>", "<|user|>", "<|assistant|>", "<|system|>")
BOS_ID = 1
EOS_ID = 2
CHAT_ROLES = ("user", "assistant", "system")
BYTE_BASE = len(SPECIAL_TOKENS)
BASE_VOCAB = BYTE_BASE + 256
VOCAB_SIZE = 32768
MIN_CHARS_CORPUS = 20
MIN_CHARS_SAMPLE = 21
TOKENS_PER_SHARD = 10_000_000
VAL_FRACTION = 0.005
TOKENS_PER_CHAR = 0.25
SHARD_NAME = "%s_%s_shard_%04d.bin"
SHARD_PATTERN = r"^(\w+)_(train|val)_shard_(\d+)\.bin$"
STALL_SECONDS = 300
UINT16_LIMIT = 65536
BYTES_PER_TOKEN = 2


@dataclass(frozen=True)
class SourceSpec:
    """One weighted source of a mixture.

    ``dataset`` is a path or path template; ``{config}`` and ``{split}`` in it are filled in,
    and a set ``config`` that the template does not mention is appended as a sub-directory.
    ``key`` is the column that fixes document order: integers are used as they are, other keys by their rank;
    without one, order is that of the files and of the rows in them.
    ``scan_partitions`` deals the rows out where the files cannot be split; by default they stay where they are read.
    """

    name: str
    dataset: str
    key: str | None = "id"
    field: str = "text"
    format: str = "parquet"
    config: str | None = None
    split: str = "train"
    filter_lang: str | None = None
    lang_column: str = "lang"
    weight: float | None = None
    max_samples: int | None = None
    turn_rows: bool = False
    schema: str | None = None
    scan_partitions: int | None = None
    options: dict = dc_field(default_factory=dict)

    @property
    def location(self) -> str:
        if self.config is not None and "{config}" not in self.dataset:
            return self.dataset.rstrip("/") + "/" + self.config
        return self.dataset.format(config=self.config, split=self.split)


@dataclass(frozen=True)
class Mixture:
    sources: tuple[SourceSpec, ...]
    tokens_per_shard: int = TOKENS_PER_SHARD
    val_fraction: float = VAL_FRACTION
    seed: int = 42

    def require_weights(self) -> None:
        missing = [s.name for s in self.sources if s.weight is None]
        if missing:
            raise ValueError(f"sources without a weight: {missing}")

    def table(self, spark):
        """The mixture as a small DataFrame, one row per source in configured order."""
        self.require_weights()
        return spark.createDataFrame(
            [(s.name, i, float(s.weight), s.field, s.filter_lang) for i, s in enumerate(self.sources)],
            "mix_source string, source_ord int, weight double, field string, filter_lang string",
        )


def parse_mixture(cfg: dict, **defaults) -> Mixture:
    """Build a Mixture from the parsed configuration mapping; ``defaults`` fill fields such as ``key``."""
    known = SourceSpec.__dataclass_fields__
    sources = []
    for name, body in cfg["sources"].items():
        values = {**defaults, **{k: v for k, v in body.items() if k in known and v is not None}}
        sources.append(SourceSpec(name=name, **values))
    return Mixture(
        tuple(sources),
        int(cfg.get("shard", {}).get("tokens_per_shard", TOKENS_PER_SHARD)),
        float(cfg.get("validation", {}).get("fraction", VAL_FRACTION)),
    )


def load_mixture(path: str, **defaults) -> Mixture:
    """Read a mixture file: JSON always, YAML where a YAML reader is installed."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        return parse_mixture(json.loads(text), **defaults)
    try:
        import yaml
    except ImportError as err:
        raise RuntimeError("no YAML reader installed; give the mixture as .json") from err
    return parse_mixture(yaml.safe_load(text), **defaults)
