from . import daily_cancel, program_audit, signup_time, waitlist

__all__ = ["daily_cancel", "program_audit", "signup_time", "waitlist"]
