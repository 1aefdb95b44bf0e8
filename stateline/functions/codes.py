"""Postal code, state or territory name, state id."""

# Fixed values.
STATES = (
    ("AL", "Alabama", 1),
    ("AK", "Alaska", 2),
    ("AS", "American Samoa", 3),
    ("AZ", "Arizona", 4),
    ("AR", "Arkansas", 5),
    ("CA", "California", 6),
    ("CO", "Colorado", 7),
    ("CT", "Connecticut", 8),
    ("DE", "Delaware", 9),
    ("DC", "District Of Columbia", 10),
    ("FM", "Federated States Of Micronesia", 11),
    ("FL", "Florida", 12),
    ("GA", "Georgia", 13),
    ("GU", "Guam", 14),
    ("HI", "Hawaii", 15),
    ("ID", "Idaho", 16),
    ("IL", "Illinois", 17),
    ("IN", "Indiana", 18),
    ("IA", "Iowa", 19),
    ("KS", "Kansas", 20),
    ("KY", "Kentucky", 21),
    ("LA", "Louisiana", 22),
    ("ME", "Maine", 23),
    ("MH", "Marshall Islands", 24),
    ("MD", "Maryland", 25),
    ("MA", "Massachusetts", 26),
    ("MI", "Michigan", 27),
    ("MN", "Minnesota", 28),
    ("MS", "Mississippi", 29),
    ("MO", "Missouri", 30),
    ("MT", "Montana", 31),
    ("NE", "Nebraska", 32),
    ("NV", "Nevada", 33),
    ("NH", "New Hampshire", 34),
    ("NJ", "New Jersey", 35),
    ("NM", "New Mexico", 36),
    ("NY", "New York", 37),
    ("NC", "North Carolina", 38),
    ("ND", "North Dakota", 39),
    ("MP", "Northern Mariana Islands", 40),
    ("OH", "Ohio", 41),
    ("OK", "Oklahoma", 42),
    ("OR", "Oregon", 43),
    ("PW", "Palau", 44),
    ("PA", "Pennsylvania", 45),
    ("PR", "Puerto Rico", 46),
    ("RI", "Rhode Island", 47),
    ("SC", "South Carolina", 48),
    ("SD", "South Dakota", 49),
    ("TN", "Tennessee", 50),
    ("TX", "Texas", 51),
    ("UT", "Utah", 52),
    ("VT", "Vermont", 53),
    ("VI", "Virgin Islands", 54),
    ("VA", "Virginia", 55),
    ("WA", "Washington", 56),
    ("WV", "West Virginia", 57),
    ("WI", "Wisconsin", 58),
    ("WY", "Wyoming", 59),
)

# A second spelling in use for id 10.
EXTRA_SPELLINGS = {"District of Columbia": 10}

CODE_TO_NAME = {code: name for code, name, _ in STATES}
NAME_TO_ID = {name: number for _, name, number in STATES} | EXTRA_SPELLINGS
