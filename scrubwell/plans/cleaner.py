"""The cleaner: an ordered list of DataFrame steps.

Each step rewrites the text column and appends what it changed to an array
column ``findings``.  All steps but language, spelling and names work inside
the row, so a run without those is one scan with no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubwell import rules
from scrubwell.functions import lengths, normalize, redact, repeats
from scrubwell.operators import dedupe, entities, findings, language, spelling
from scrubwell.operators.seen import SeenTexts
from scrubwell.plans.config import CleanConfig
from scrubwell.session import settle, stage

Step = Callable[[DataFrame], DataFrame]
TABLE_STEPS = ("translate_lang", "spell_check", "replace_entities")


class Cleaner:
    """Cleans a table of texts.

    ``vocabulary`` (``term, freq``), ``language_model`` and ``gazetteer``
    (``term, label``) are needed by the steps that use them: a step that is on
    without its table is an error, see ``config.NO_TABLES``.  ``extra_steps`` are DataFrame functions run at the end.
    With ``keep_code=False`` white space, control characters and mis-decoded
    characters are cleaned in texts that hold code too.
    With ``audit_texts=False`` findings about a whole text hold its SHA-256
    instead of the text, which keeps the findings far smaller than the corpus.
    """

    def __init__(
        self,
        config: CleanConfig | None = None,
        *,
        key: str | list[str] = "doc_id",
        text: str = "text",
        tokens: dict[str, str] | None = None,
        profanity: tuple[str, ...] = rules.PROFANITY,
        hmac_key: str | None = None,
        gate: str = "none",
        whole_sentences: bool = True,
        keep_code: bool = True,
        vocabulary: DataFrame | None = None,
        language_model: language.LanguageModel | None = None,
        gazetteer: DataFrame | None = None,
        audit_texts: bool = True,
        extra_steps: tuple[Step, ...] = (),
    ):
        self.config = config or CleanConfig()
        self.keys = [key] if isinstance(key, str) else list(key)
        self.text = text
        self.tokens = rules.TOKENS | (tokens or {})
        self.profanity = tuple(profanity)
        self.hmac_key = hmac_key
        self.gate = gate
        self.whole_sentences = whole_sentences
        self.keep_code = keep_code
        self.vocabulary = vocabulary
        self.language_model = language_model
        self.gazetteer = gazetteer
        self.audit_texts = audit_texts
        self.extra_steps = tuple(extra_steps)

    # -- building blocks ----------------------------------------------------

    def _rewrite(
        self,
        name: str,
        tag: str,
        change: Callable[[Column], Column],
        first_match: str | None = None,
        log_result: bool = False,
    ) -> Step:
        """A step on the whole text; one finding where the text changed."""

        def run(df: DataFrame) -> DataFrame:
            return self._log_change(
                df.withColumn("_new", change(F.col(self.text))), name, tag, first_match, log_result
            )

        return run

    def _whole(self, text: Column) -> Column:
        return text if self.audit_texts else F.sha2(F.encode(text, "UTF-8"), 256)

    def _log_change(self, df, name, tag, first_match=None, log_result=False) -> DataFrame:
        old, new = F.col(self.text), F.col("_new")
        original = F.regexp_substr(old, F.lit(first_match)) if first_match else self._whole(old)
        found = F.struct(
            F.lit(name).alias("step"),
            F.lit(tag).alias("tag"),
            original.alias("original"),
            (self._whole(new) if log_result else F.lit(None).cast("string")).alias("replacement"),
            F.lit(0).alias("pos"),
        )
        changed = ~old.eqNullSafe(new)
        logged = F.when(changed, F.concat("findings", F.array(found))).otherwise(F.col("findings"))
        return self._replace(df, {"findings": logged, self.text: new}, drop="_new")

    @staticmethod
    def _replace(df: DataFrame, changed: dict[str, Column], drop: str) -> DataFrame:
        return df.select(
            *[
                changed[name].alias(name) if name in changed else F.col(name)
                for name in df.columns
                if name != drop
            ]
        )

    def _redaction(self, name: str, rule_list: list[redact.Rule]) -> Step:
        """A step made of rules; one finding per replaced match."""

        def apply(df: DataFrame, rule: redact.Rule) -> DataFrame:
            hits = F.col("_hits")
            found = F.transform(
                rule.accepted(hits),
                lambda hit: F.struct(
                    F.lit(name).alias("step"),
                    F.lit(rule.tag).alias("tag"),
                    hit["original"].alias("original"),
                    rule.replacement(hit["original"]).alias("replacement"),
                    hit["pos"].alias("pos"),
                ),
            )
            more = F.when(
                F.size(hits) > 0, F.concat("findings", F.coalesce(found, findings.no_findings()))
            ).otherwise(F.col("findings"))
            return self._replace(
                df.select("*", rule.candidates(F.col(self.text)).alias("_hits")),
                {
                    "findings": more,
                    self.text: rule.apply(F.col(self.text), None if rule.plain else hits),
                },
                drop="_hits",
            )

        return lambda df: reduce(apply, rule_list, df)

    # -- steps that join ----------------------------------------------------

    def _route(self, df: DataFrame) -> DataFrame:
        return language.route_foreign(df, self.language_model, self.text)

    def _blank(self, df: DataFrame) -> DataFrame:
        if "needs_translation" not in df.columns:
            df = self._route(df)
        blanked = F.when(F.col("needs_translation"), "").otherwise(F.col(self.text))
        return self._log_change(
            df.withColumn("_new", blanked), "remove_lang", "LANGUAGE_REMOVE", log_result=True
        )

    def _spell(self, df: DataFrame) -> DataFrame:
        """English only, where the language is known; profanity is left for its own step."""
        old = "_before"
        home = F.lit(True)
        if "lang_detected" in df.columns:
            home = F.coalesce(F.col("lang_detected") == "en", F.lit(True))
        suggestions = spelling.spelling_map(
            df.filter(home), self.vocabulary, self.text, redact.profanity_pattern(self.profanity)
        )
        fixed = spelling.correct_spelling(
            df.withColumn(old, F.col(self.text)), suggestions, self.text
        )
        swapped = fixed.withColumnsRenamed({self.text: "_new", old: self.text})
        swapped = swapped.withColumn("_new", F.when(home, F.col("_new")).otherwise(F.col(self.text)))
        return self._log_change(swapped, "spell_check", "SPELLING", log_result=True).select(
            *df.columns
        )

    def _names(self, df: DataFrame) -> DataFrame:
        names = entities.prepare_gazetteer(self.gazetteer)
        found = entities.redact_entities(
            df, names, self.text, self.tokens["NAME"], self.hmac_key, spans="_spans"
        )
        rule = redact.Rule("NAME", "", self.tokens["NAME"], key=self.hmac_key)
        rows = F.transform(
            F.col("_spans"),
            lambda span, at: F.struct(
                F.lit("replace_entities").alias("step"),
                F.lit("NAME").alias("tag"),
                span["term"].alias("original"),
                rule.replacement(span["term"]).alias("replacement"),
                at.alias("pos"),
            ),
        )
        logged = F.concat("findings", F.coalesce(rows, findings.no_findings()))
        return found.withColumn("findings", logged).drop("_spans")

    # -- the list -----------------------------------------------------------

    def steps(self) -> list[tuple[str, Step]]:
        """Name and function of every step that will run, in order."""
        cfg, tokens, key, gate = self.config, self.tokens, self.hmac_key, self.gate
        pii = redact.url(tokens, key) + redact.email(tokens, key)
        if cfg.anonymize_currency:
            pii += redact.candidate_currency(key)
        pii += redact.phone(tokens, key)
        # --- fixed values: the audit tags of the steps ---
        available: dict[str, Step | None] = {
            "normalize_unicode": self._rewrite("normalize_unicode", "NFC", normalize.normalize_nfc),
            "translate_lang": self._route if self.language_model else None,
            "remove_lang": self._blank if self.language_model else None,
            "remove_html_tags": self._redaction("remove_html_tags", redact.html(tokens)),
            "collapse_whitespace": self._rewrite(
                "collapse_whitespace",
                "MULTISPACE",
                lambda text: normalize.collapse_space(text, self.keep_code),
                rules.SPACES,
            ),
            "remove_control_chars": self._rewrite(
                "remove_control_chars",
                "CONTROL",
                lambda text: normalize.strip_control(text, self.keep_code),
                rules.CONTROL,
            ),
            "remove_nonprintable": self._rewrite(
                "remove_nonprintable", "STRIP_NONPRINTABLE", normalize.strip_nonprintable
            ),
            "shrink_repeated_chars": self._rewrite(
                "shrink_repeated_chars",
                "SHRINK_REPEATS",
                normalize.shrink_runs,
                rules.REPEATED_CHAR,
            ),
            "remove_lead_trail": self._rewrite(
                "remove_lead_trail", "STRIP_LEAD_TRAIL", normalize.trim_text
            ),
            "remove_code": self._redaction("remove_code", redact.code(tokens)),
            "fix_mojibake": self._rewrite(
                "fix_mojibake",
                "MOJI_FIX",
                lambda text: normalize.repair_mojibake(text, self.keep_code),
            ),
            "spell_check": self._spell if self.vocabulary is not None else None,
            "replace_entities": self._names if self.gazetteer is not None else None,
            "replace_profanity": self._redaction(
                "replace_profanity", redact.profanity(self.profanity, tokens, key)
            ),
            "replace_ip": self._redaction(
                "replace_ip", redact.ipv4(tokens, key, gate) + redact.ipv6(tokens, key, gate)
            ),
            "replace_uuid": self._redaction("replace_uuid", redact.uuid(tokens, key, gate)),
            "replace_mac": self._redaction("replace_mac", redact.mac(tokens, key, gate)),
            "replace_timestamp": self._redaction(
                "replace_timestamp", redact.timestamp(tokens, key)
            ),
            "replace_filepath": self._redaction("replace_filepath", redact.filepath(tokens, key)),
            "replace_ssn": self._redaction("replace_ssn", redact.ssn(tokens, key, gate)),
            "replace_cc": self._redaction("replace_cc", redact.credit_card(tokens, key, gate)),
            "anonymize_pii": self._redaction("anonymize_pii", pii),
            "remove_pii": self._redaction("remove_pii", redact.pii_removal()),
            "anonymize_currency": self._redaction(
                "anonymize_currency", redact.currency(tokens, key)
            ),
            "check_repeats": self._rewrite(
                "check_repeats",
                "RM_REPEATS",
                lambda text: repeats.drop_repeats(text, int(cfg.check_repeats or 0)),
                log_result=True,
            ),
            "min_drop_length": self._rewrite(
                "min_drop_length",
                "TOO SHORT",
                lambda text: lengths.null_short(text, cfg.min_drop_length),
            ),
            "max_chars": self._rewrite(
                "max_chars", "MAX_CHARS", lambda text: lengths.truncate_chars(text, cfg.max_chars)
            ),
            "max_tokens": self._rewrite(
                "max_tokens",
                "MAX_TOKENS",
                lambda text: lengths.truncate_tokens(text, cfg.max_tokens, self.whole_sentences),
            ),
        }
        bare = [name for name in cfg.active() if available[name] is None]
        if bare:
            raise ValueError(f"steps without their table: {', '.join(bare)}")
        chosen = [(name, available[name]) for name in cfg.active()]
        return chosen + [(f"extra_{n}", step) for n, step in enumerate(self.extra_steps, 1)]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its text cleaned and a ``findings`` array added.

        The steps that join read their input more than once.  Spelling and
        names come late in the list, and whatever follows a join is costly too,
        so there the texts are written to the shared folder and read from it.
        """
        df = df.withColumn("findings", findings.no_findings())
        computed, joined = [self.text, "findings"], False
        for name, step in self.steps():
            joins = name in TABLE_STEPS or (
                name == "remove_lang" and "needs_translation" not in df.columns
            )
            if joins and (joined or name in ("spell_check", "replace_entities")):
                df = stage(df, f"before-{name}")
            elif joins:
                df = settle(df, computed)
            df = step(df)
            joined = joined or joins
        return settle(df, computed)

    def prepared(self) -> Cleaner:
        """This cleaner with its dictionaries written once, for many tables or micro-batches."""
        ready = copy(self)
        if self.vocabulary is not None:
            ready.vocabulary = spelling.prepare_vocabulary(self.vocabulary)
        if self.gazetteer is not None:
            ready.gazetteer = entities.prepare_gazetteer(self.gazetteer)
        return ready

    def clean(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``cleaned`` and ``findings``, two tables from one pass over the texts.

        The pass is written to the shared folder once; both results read it.
        """
        done = stage(self.transform(df), "cleaned")
        return done.drop("findings"), findings.explode_findings(done, self.keys)

    def clean_distinct(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Like :meth:`clean`, without dropped texts and repeated cleaned texts."""
        kept = dedupe.dedupe_texts(self.transform(df), self.keys[0], self.text)
        done = stage(kept, "cleaned")
        return done.drop("findings"), findings.explode_findings(done, self.keys)

    def clean_new(self, df: DataFrame, seen: SeenTexts, run: str) -> tuple[DataFrame, DataFrame]:
        """Like :meth:`clean_distinct`, without texts that earlier runs have let through."""
        done = seen.first_sights(self.transform(df), run, self.keys[0], self.text)
        return done.drop("findings"), findings.explode_findings(done, self.keys)
