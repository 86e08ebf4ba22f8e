from .rentals import stream_rentals

__all__ = ["stream_rentals"]
