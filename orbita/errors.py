"""What the engine raises on purpose; the message names every finding, not only the first."""


class EngineError(Exception):
    """Root: catch it to tell a refusal from a crash."""


class SharedFolderMissing(EngineError):
    """A cluster session names no folder that driver and executors share."""


class SourceUnreadable(EngineError):
    """A source is missing, unreadable, empty, or lacks contract columns."""


class RulesViolated(EngineError):
    """Blocking findings of the rules of a stage."""


class JoinRefused(EngineError):
    """The two sources do not join one-to-one."""


class CleaningRefused(EngineError):
    """Rows that no cleaning policy may mend (ids, columns without a value)."""


class ModelInputRefused(EngineError):
    """Rows or feature lists that a model must not be fitted on."""


class StagesDisagree(EngineError):
    """Results of stages that do not fit together, found before publication."""


class PublicationBroken(EngineError):
    """A published folder that readers cannot use: no complete version, or one that lacks what it lists."""
