"""Which steps run, and in which order."""

from __future__ import annotations

from dataclasses import dataclass, fields


# Switches of the default steps that need a table; off for a cleaner without tables.
NO_TABLES = {"translate_lang": False, "spell_check": False, "replace_entities": False}


# --- fixed values: names, order and defaults of the switches ---------------
@dataclass(frozen=True)
class CleanConfig:
    """Switches of the cleaner.  The order of the fields is the order of the steps."""

    normalize_unicode: bool = True
    translate_lang: bool = True  # marks texts that need translation; needs a language model
    remove_lang: bool = False  # needs a language model
    remove_html_tags: bool = True
    collapse_whitespace: bool = True
    remove_control_chars: bool = True
    remove_nonprintable: bool = True
    shrink_repeated_chars: bool = True
    remove_lead_trail: bool = True
    remove_code: bool = False
    fix_mojibake: bool = True
    spell_check: bool = True  # needs a vocabulary
    replace_entities: bool = True  # needs a name table
    replace_profanity: bool = True
    replace_ip: bool = False
    replace_uuid: bool = True
    replace_mac: bool = True
    replace_timestamp: bool = True
    replace_filepath: bool = True
    replace_ssn: bool = True
    replace_cc: bool = True
    anonymize_pii: bool = True
    remove_pii: bool = False
    anonymize_currency: bool = False
    check_repeats: int | None = 2
    min_drop_length: int = 1
    max_chars: int | None = None
    max_tokens: int | None = None

    def active(self) -> list[str]:
        """Names of the switched-on steps in order."""
        return [field.name for field in fields(self) if getattr(self, field.name)]
