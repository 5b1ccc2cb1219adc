"""Job options."""

from __future__ import annotations

from dataclasses import dataclass

from chatloom.functions.hashing import DEFAULT_SALT


@dataclass(frozen=True)
class JobOptions:
    """Settings of one transformation job.

    ``mask_auth_data`` keeps raw addresses out of anonymised payloads; switch it
    off for payloads that must match the unmasked form.
    """

    anonymize: bool = False
    salt: str = DEFAULT_SALT
    batch_size: int = 500
    fail_on_empty: bool = True
    auth_service: str | None = None
    auth_data_field: str = "email"
    resume: bool = True
    max_chunk_mb: int = 0
    mask_auth_data: bool = True

    def __post_init__(self) -> None:
        if not 1 <= self.batch_size <= 10_000:
            raise ValueError("batch_size must lie between 1 and 10000")
        if self.max_chunk_mb < 0:
            raise ValueError("max_chunk_mb must not be negative")
        field = self.auth_data_field.strip().lower()
        if field not in ("email", "username"):
            raise ValueError("auth_data_field must be 'email' or 'username'")
        object.__setattr__(self, "auth_data_field", field)
