"""One configuration row per content domain; no operator branches on the name."""

from __future__ import annotations

from dataclasses import dataclass

DEFAULT_RULE = -100
TOP_N = 200
LOG_COLUMNS = ("username", "content_id", "duration", "profile_id")


@dataclass(frozen=True)
class NetworkConfig:
    """Shape of the two-branch cross network.

    ``normalise_cross``: the layer-normed projection itself enters the cross
    term (otherwise only its ReLU mask is layer-normed). ``chain_deep``: the deep
    branch multiplies by the running vector instead of the input vector.
    """

    deep_layers: int
    shallow_layers: int
    clip: float
    dropout: float
    normalise_cross: bool = False
    batch_norm: bool = False
    gated: bool = False
    chain_deep: bool = False
    init: str = "xavier"


@dataclass(frozen=True)
class DomainConfig:
    name: str
    catalogue_globs: tuple[str, ...]
    item_columns: tuple[str, ...]
    one_hot: tuple[str, ...]
    network: NetworkConfig
    multi_hot: str = "content_cate_id"
    scaled: tuple[str, ...] = ()
    min_share: float | None = None
    min_count: int | None = None
    log_duration: bool = True
    validation_share: float = 0.2
    weighted_loss: bool = True
    optimiser: str = "adam"
    learning_rate: float = 1e-3
    weight_decay: float = 0.0
    cosine_period: int | None = None
    rounds: int = 5
    epochs: int = 20
    patience: int = 3
    batch_rows: int = 2048

    @property
    def numeric(self) -> tuple[str, ...]:
        """Item columns that enter the feature row as they are."""
        skip = {"content_id", "tag_names", self.multi_hot, *self.one_hot, *self.scaled}
        return tuple(c for c in self.item_columns if c not in skip)


# The label rules, column lists and training parameters per domain.
_SINGLE = NetworkConfig(deep_layers=1, shallow_layers=1, clip=100.0, dropout=0.1)

DOMAINS: dict[str, DomainConfig] = {
    "movie": DomainConfig(
        name="movie",
        catalogue_globs=("content_movie_2*.json",),
        item_columns=(
            "content_id", "content_single", "content_publish_year", "content_country",
            "type_id", "tag_names", "content_duration", "content_status", "VOD_CODE",
            "content_cate_id",
        ),
        one_hot=("content_country", "VOD_CODE", "type_id"),
        scaled=("content_publish_year",),
        min_share=0.9,
        min_count=3,
        learning_rate=1e-2,
        network=NetworkConfig(
            deep_layers=1, shallow_layers=1, clip=100.0, dropout=0.05, normalise_cross=True
        ),
    ),
    "clip": DomainConfig(
        name="clip",
        catalogue_globs=("content_clip_2*.json",),
        item_columns=(
            "content_id", "content_publish_year", "type_id", "tag_names",
            "content_duration", "content_status", "VOD_CODE", "content_cate_id",
        ),
        one_hot=("VOD_CODE", "type_id"),
        scaled=("content_publish_year",),
        min_share=0.3,
        network=_SINGLE,
    ),
    "music": DomainConfig(
        name="music",
        catalogue_globs=("music_video_2*.json",),
        item_columns=(
            "content_id", "type_id", "tag_names", "content_duration", "content_status",
            "VOD_CODE", "content_cate_id",
        ),
        one_hot=("VOD_CODE", "type_id"),
        min_share=1.0,
        min_count=2,
        network=_SINGLE,
    ),
    "all": DomainConfig(
        name="all",
        catalogue_globs=(
            "content_movie_2*.json", "content_clip_2*.json", "music_video_2*.json",
        ),
        item_columns=(
            "content_id", "type_id", "tag_names", "content_duration", "content_status",
            "VOD_CODE", "content_cate_id",
        ),
        one_hot=("VOD_CODE", "type_id"),
        min_count=2,
        log_duration=False,
        validation_share=0.3,
        weighted_loss=False,
        optimiser="adamw",
        weight_decay=1e-4,
        cosine_period=30,
        epochs=30,
        patience=4,
        network=NetworkConfig(
            deep_layers=2, shallow_layers=4, clip=10.0, dropout=0.1, batch_norm=True,
            gated=True, chain_deep=True, init="kaiming",
        ),
    ),
}
