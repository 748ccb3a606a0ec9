"""Tables in the folder that all executors see."""

from ..sources.scratch import shared_folder, written

__all__ = ["shared_folder", "written"]
