"""DataFrame -> DataFrame operators over the line table and its lookups.

Line tables carry ``workpack_id`` and ``row_no``. ``row_no`` gives the order of
the lines inside a package: any orderable type, unique per package, gaps allowed.
"""
