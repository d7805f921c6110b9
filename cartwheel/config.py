"""Settings for a run, with the defaults of the shipped parameter file."""

from __future__ import annotations

from configparser import ConfigParser
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Columns:
    """Names of the purchase-event columns."""

    user: str = "network_userid"
    item: str = "item_id"
    rating: str = "item_quantity"
    order: str = "order_id"
    date: str = "datestamp"


@dataclass(frozen=True)
class Config:
    """One run of extract, split, train, evaluate and select."""

    columns: Columns = field(default_factory=Columns)

    # Defaults of the shipped parameter file.
    data_path: str = "purchases.csv"
    end_date: str = "2025-09-10"
    num_days: int | None = 31
    test_fraction: float = 0.2
    output_base: str = "model_data"
    train_base: str = "model_train"
    checkpoint_base: str = "model_checkpoints"
    latest_model_dir: str = "models/latest"
    metrics_dir: str = "model_metrics"
    n_factors: int = 16
    learning_rate: float = 0.005
    batch_size: int = 512
    epochs: int = 10
    reg_lambda: float = 0.001
    ndcg_k: int = 10
    n_hash_tables: int = 5
    n_hash_functions: int = 10
    lsh_seed: int = 42

    # Ours: all test users are evaluated unless a sample is asked for; None for num_days takes every date.
    eval_sample_users: int | None = None

    # Ours: shrinkage of the user and item means in the bias model.
    bias_damping: float = 10.0

    @classmethod
    def from_ini(cls, path: str) -> Config:
        """Read an ini file; keys that are absent keep their defaults."""
        ini = ConfigParser()
        with open(path) as handle:
            ini.read_file(handle)
        values = {key: value for section in ini.sections() for key, value in ini.items(section)}
        names = {f.name: values[f"{f.name}_col"] for f in fields(Columns) if f"{f.name}_col" in values}
        cast = {"int": int, "float": float, "str": str, "int | None": lambda x: int(x) if x.strip() else None}
        own = {f.name: cast[f.type](values[f.name]) for f in fields(cls) if f.type in cast and f.name in values}
        return replace(cls(columns=Columns(**names)), **own)
