"""What the commands need to know, from the environment; development secrets are refused anywhere else."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields

#: Secrets that stand in public set-up files for development; nobody may rely on them elsewhere.
DEVELOPMENT_SECRETS = ("changeme", "dev-only-secret", "tidewatch-dev")
#: The build's schedule, off until someone turns it on: every so many hours, in UTC.
SCHEDULE = {"every_hours": 6, "zone": "UTC", "enabled": False}


class UnsafeSettings(ValueError):
    """A development secret outside the local environment."""


@dataclass(frozen=True)
class Settings:
    """``environment`` is ``local`` or the name of a deployment; a honeypot's models are built only with ``honeypot``."""

    environment: str = "local"
    root: str = "lake"
    honeypot: bool = False
    log_folder: str = ""
    log_command: str = ""
    pseudonym_key: str = ""
    run_url: str = ""
    revision: str = ""

    @classmethod
    def load(cls, environ: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if environ is None else environ
        raw = {f.name: env[name] for f in fields(cls) if (name := f"TIDEWATCH_{f.name.upper()}") in env}
        if "honeypot" in raw:
            raw["honeypot"] = raw["honeypot"].lower() in ("1", "true", "yes", "on")
        found = cls(**raw)
        found.check()
        return found

    def check(self) -> None:
        if self.environment != "local" and any(s in self.pseudonym_key.lower() for s in DEVELOPMENT_SECRETS):
            raise UnsafeSettings(f"a development secret in the environment {self.environment!r}")

    def shown(self) -> dict:
        """For printing: secrets only as whether they are set."""
        return asdict(self) | {"pseudonym_key": "set" if self.pseudonym_key else "not set"}
