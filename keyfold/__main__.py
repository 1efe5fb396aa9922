"""``python -m keyfold ...`` runs the job runner (see :mod:`keyfold.jobs`)."""

from keyfold.jobs import main

if __name__ == "__main__":
    main()
