from .stateless import prepare_stream

__all__ = ["prepare_stream"]
