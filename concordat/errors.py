"""One error class per stage; all are raised before anything is written."""


class ConcordatError(Exception):
    """A refusal."""


class IngestError(ConcordatError):
    pass


class ProfileError(ConcordatError):
    pass


class LinkError(ConcordatError):
    pass


class ProposeError(ConcordatError):
    pass


class ConfirmError(ConcordatError):
    pass


class MappingError(ConcordatError):
    pass


class ConversionError(MappingError):
    pass


class ValueMapError(MappingError):
    pass


class InvariantError(ConcordatError):
    pass
