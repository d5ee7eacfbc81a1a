"""Ready-made rules for account records."""

from __future__ import annotations

from tablewright.functions.text import trimmed
from tablewright.operators.rules import Field, Ref, RecordRules

# Bounds of the account forms, and what they say.
LONGEST_TEXT = 255
LONGEST_PASSWORD = 10
CODE_LENGTH = 4
SAID = {
    "email": "Must be a valid email",
    "email required": "Email is required",
    "password required": "Password is required",
    "password padded": "Password can not start or end with spaces",
    "password long": "Password must be less than 10 characters",
    "firstname required": "First Name is required",
    "lastname required": "Last Name is required",
    "confirm required": "Confirm Password is required",
    "confirm equal": "Both Password must be match!",
    "code length": "OTP must be exactly 4 digits",
    "code required": "OTP is required",
}


def not_padded(f: Field, message: str) -> Field:
    """The text neither starts nor ends with white space."""
    return f.test(
        "no-leading-trailing-whitespace", message, lambda s: s.value == trimmed(s.value)
    )


def equal_to(f: Field, other: str, message: str) -> Field:
    """The cell equals that of another field."""
    return f.test(
        f.name, message, lambda s: s.value.eqNullSafe(s.resolve(Ref(other))), skip_absent=False
    )


def email_field() -> Field:
    return (
        Field("email")
        .email(SAID["email"])
        .max(LONGEST_TEXT)
        .required(SAID["email required"])
    )


def password_field() -> Field:
    f = Field("password").required(SAID["password required"])
    f = not_padded(f, SAID["password padded"])
    return f.max(LONGEST_PASSWORD, SAID["password long"])


def register_rules() -> RecordRules:
    return RecordRules(
        (
            Field("firstname").max(LONGEST_TEXT).required(SAID["firstname required"]),
            Field("lastname").max(LONGEST_TEXT).required(SAID["lastname required"]),
            email_field(),
            password_field(),
        )
    )


def login_rules() -> RecordRules:
    return RecordRules((email_field(), password_field()))


def forgot_rules() -> RecordRules:
    return RecordRules((email_field(),))


def reset_rules() -> RecordRules:
    confirm = Field("confirmPassword").required(SAID["confirm required"])
    return RecordRules(
        (
            Field("password").max(LONGEST_TEXT).required(SAID["password required"]),
            equal_to(confirm, "password", SAID["confirm equal"]),
        )
    )


def code_rules() -> RecordRules:
    code = Field("otp").length(CODE_LENGTH, SAID["code length"])
    return RecordRules((code.required(SAID["code required"]),))
