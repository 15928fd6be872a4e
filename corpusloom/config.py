"""Settings of a deployment: an immutable value, overridable from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Constants of the ingestion and retrieval pipeline."""

    base_url: str = "https://listing.example.org/app/"
    id_prefix: str = "REC"
    table_id: str = "employee_list"
    first_year: int = 2010
    last_year: int = 2026
    schema_version: int = 2
    chunk_words: int = 380
    overlap_words: int = 60
    top_k: int = 5
    max_top_k: int = 20
    snippet_chars: int = 280
    embedding_dim: int = 384
    request_spacing_s: float = 3.0

    @staticmethod
    def from_env(prefix: str = "CORPUSLOOM_") -> Settings:
        """Each field can be set by an environment variable of its name in upper case."""
        kinds = {"int": int, "float": float, "str": str}
        given = {f.name: kinds[f.type](os.environ[prefix + f.name.upper()]) for f in fields(Settings) if prefix + f.name.upper() in os.environ}
        return Settings(**given)

    @property
    def years(self) -> range:
        return range(self.first_year, self.last_year + 1)
