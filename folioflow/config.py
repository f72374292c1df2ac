"""Settings: defaults, then the environment, then explicit arguments."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace

#: Where systems keep their certificates.
CA_BUNDLES = ("/etc/ssl/certs/ca-certificates.crt", "/etc/pki/tls/certs/ca-bundle.crt")
_TRUE = {"1", "true", "yes", "on"}


@dataclass(frozen=True)
class Config:
    """Settings of an OCR run. Environment variables are the upper-case names under PREFIX."""

    PREFIX = "FOLIOFLOW_"
    backend: str = "mock"
    api_key: str = ""
    base_url: str = ""
    timeout_s: int = 120
    page_dpi: int = 200
    table_dpi: int = 300
    table_rescue: bool = True
    rescue_max_area: float = 0.5
    min_figure_area: float = 0.015
    cache_dir: str = "ocr_cache"
    assets_dir: str = "assets"
    visitor_token: str = ""
    model: str = ""
    ca_bundle: str = ""

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Config:
        """A value that is no number where one is due falls back to the default; certificates to those of the system."""
        env = os.environ if env is None else env
        out = cls()
        for f in fields(cls):
            raw = env.get(cls.PREFIX + f.name.upper())
            if raw is None:
                continue
            default = getattr(out, f.name)
            if isinstance(default, bool):
                value = raw.strip().lower() in _TRUE
            elif isinstance(default, (int, float)):
                try:
                    value = type(default)(raw)
                except ValueError:
                    value = default
            else:
                value = raw
            out = replace(out, **{f.name: value})
        return out if out.ca_bundle else replace(out, ca_bundle=next((x for x in CA_BUNDLES if os.path.exists(x)), ""))

    def validate(self) -> None:
        if self.backend != "mock" and not self.api_key:
            raise ValueError(f"backend {self.backend} needs an API key")
